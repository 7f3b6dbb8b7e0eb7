"""Shipment claims reconciliation as Spark DataFrame operators."""

from claimtrace.params import Params

__all__ = ["Params"]
