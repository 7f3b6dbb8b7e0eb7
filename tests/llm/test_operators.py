"""The operators against brute force, on hand-made rows: nulls, empty and long texts, ties, repeats."""

from __future__ import annotations

import array
import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from claimtrace.llm import bpe, exact, fingerprints, language, near, packing, sharding, substrings, token_counts, tokens, urls

WORDS = P.path("word_bpe_49k.json")
SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = "doc_id long, text string, lang string, id int, block string, size string, keep string, kind string"


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}{r.choice(['', '', ',', '.'])}" for _ in range(n))


def sample() -> list[tuple[int | None, str | None]]:
    passage = prose(1000, 60)
    rows: list[tuple[int | None, str | None]] = [(i, prose(i, 20 + 13 * i)) for i in range(30)]
    rows += [(100 + i, prose(5, 85)) for i in range(12)]  # copies of 5
    rows += [(200 + i, f"{prose(300 + i, 50)}\n{passage} {prose(400 + i, 50)}") for i in range(8)]
    rows += [(300 + i, prose(7, 111) + f" tail{i}") for i in range(15)]  # near copies
    rows += [(400, None), (401, ""), (402, "  \n\t "), (403, "one two"), (404, "one two"), (405, "É" * 3000)]
    rows += [(406, "the " * 400), (407, "a\u00a0b \u2003c  \x1c d\n\n e"), (408, prose(8, 3000)), (None, "id is null"), (None, None)]
    rows += [(409, "same row"), (409, "same row"), (410, "ONE two Three four five six"), (411, "one Two three Four five six")]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k, t, "en", 1, "b", "s", None, "k") for k, t in sample()]
    return spark.createDataFrame(rows, EXTRA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], EXTRA)


def test_token_counts(docs, none):
    known = Tokenizer.from_file(WORDS)
    sizes = [len(known.encode(t or "", add_special_tokens=False).ids) for _, t in sample()]
    sums = token_counts.suffix_sums(token_counts.histogram(docs, WORDS)).collect()
    assert {r.length: r.docs for r in sums} == Counter(sizes)
    for r in sums:
        assert r.docs_at_least == sum(s >= r.length for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= r.length)
        assert r.truncated_tokens == sum(min(s, r.length) for s in sizes)
        assert r.total_tokens == sum(sizes) and r.share == pytest.approx(sum(s <= r.length for s in sizes) / len(sizes))
    frame = token_counts.suffix_sums(token_counts.histogram(docs, WORDS)).cache()
    limits = token_counts.at_limits(frame, [0, 5, 100, 10**7]).collect()
    assert {r.limit: (r.docs_longer, r.truncated_tokens) for r in limits} == {
        x: (sum(s > x for s in sizes), sum(min(s, x) for s in sizes)) for x in (0, 5, 100, 10**7)
    }
    assert token_counts.quantile(frame, 0.5) == sorted(sizes)[(len(sizes) + 1) // 2 - 1]
    assert token_counts.suffix_sums(token_counts.histogram(none, WORDS)).count() == 0


def test_words_equal_the_whole_text():
    known = Tokenizer.from_file(WORDS)
    own = tokens.Words(WORDS, most=50)
    for _, text in [*sample(), (0, "Don't stop!! it's <|endoftext|> 3.14 naïve ÀÉ ΣΑΣ ²x İ e\u0301 ．\x85z 日本語 \u200b")]:
        ids = array.array("I", known.encode(text or "", add_special_tokens=False).ids).tobytes()
        assert own.ids((text or "").encode()) == ids


def test_packing(docs, none):
    known = Tokenizer.from_file(WORDS)
    for capacity in (64, 4096):
        rows = packing.pack(docs, WORDS, capacity).collect()
        want = Counter()
        for key, text in sample():
            ids = [*known.encode(text or "", add_special_tokens=False).ids, 1]
            for n, at in enumerate(range(0, len(ids), capacity)):
                part = ids[at : at + capacity]
                want[key, n, at, len(part), zlib.crc32(array.array("I", part).tobytes())] += 1
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
        held = defaultdict(list)
        for r in rows:
            held[r.sequence_id].append((r.offset, r.length))
        for parts in held.values():
            assert [o for o, _ in sorted(parts)] == [0, *np.cumsum([n for _, n in sorted(parts)])[:-1]]
            assert sum(n for _, n in parts) <= capacity
        assert len(held) <= 1.03 * sum(r.length for r in rows) / capacity + 1
    assert packing.pack(none, WORDS).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_packing_plan(seed):
    r = random.Random(seed)
    counts = Counter(min(64, max(1, int(r.lognormvariate(2.5, 1)))) for _ in range(3000))
    made = packing.plan(counts, 64)
    used = Counter()
    for held, n in made:
        assert n > 0 and sum(held) <= 64
        for x in held:
            used[x] += n
    assert used == counts
    assert sum(n for _, n in made) <= -(-sum(k * v for k, v in counts.items()) // 64) + 2


def test_exact_complements_come_first():
    assert packing.plan({60: 2, 4: 1, 3: 1, 1: 1}, 64) == [((60, 4), 1), ((60, 3, 1), 1)]
    assert packing.plan({50: 1, 7: 1, 4: 1, 3: 1}, 64) == [((50, 7, 4, 3), 1)] or sum(packing.plan({50: 1, 7: 1, 4: 1, 3: 1}, 64)[0][0]) == 64


def test_substrings(docs, none):
    words = [(k, SPLIT.findall(t or "")) for k, t in sample()]
    seen = Counter(tuple(w[i : i + 35]) for _, w in words for i in range(len(w) - 34))
    want = Counter()
    for key, w in words:
        covered = set()
        for i in range(len(w) - 34):
            if seen[tuple(w[i : i + 35])] > 1:
                covered.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in covered)
        want[key, len(w), len(covered), hashlib.sha256(kept.encode()).hexdigest()] += 1
    rows = substrings.remove(docs, carry=("lang", "id")).collect()
    assert Counter((r.id, r.n_words, r.n_removed, r.sha) for r in rows) == want
    assert sum(r.n_removed for r in rows) > 500 and all(r.rest.lang == "en" for r in rows)
    texts = dict(sample())
    assert all(r.text == (texts[r.id] or "") for r in rows if r.id in (402, 407))
    assert substrings.remove(none).count() == 0


@pytest.mark.parametrize("words", [3, 40, 100_000])
def test_equal_windows_have_equal_anchors(words):
    """Copies of passages in other surroundings, few and many different words, runs."""
    r = np.random.default_rng(words)
    passages = [r.integers(0, words, n).astype(np.uint64) for n in (35, 36, 50, 200)] + [np.full(80, 1, np.uint64)]
    texts = [np.concatenate([r.integers(0, words, r.integers(0, 40)).astype(np.uint64), passages[i % 5], r.integers(0, words, 20).astype(np.uint64)]) for i in range(60)]
    from claimtrace.llm.common import mix

    row, starts = substrings.joined(mix(np.concatenate(texts) + np.uint64(1)), np.cumsum([len(t) for t in texts]))
    valid = substrings.windows(starts, np.array([len(t) for t in texts]), len(row), 35)
    best, numbers, places = substrings.anchors(row, valid, 35)
    by_window, count = {}, Counter(numbers.tolist())
    at = defaultdict(set)
    for p in np.flatnonzero(valid).tolist():
        key = row[p : p + 35].tobytes()
        assert by_window.setdefault(key, best[p]) == best[p]
        at[key].add(p)
    hashed = substrings.window_numbers(row, 35)
    assert len({int(hashed[p]) for p in np.flatnonzero(valid)}) == len(by_window)
    for key, found in at.items():
        if len(found) > 1:
            assert count[int(by_window[key])] > 1


def test_anchors_of_large_batches_take_little_memory():
    """A batch of 16 MB: numpy holds the arrays of one small slice, so tasks of one executor fit beside each other."""
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(1)
    texts = [b" ".join(b"w%d" % w for w in r.integers(0, 50_000, 300)) for _ in range(8000)]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(texts)) % 50, pa.int32()), pa.array(texts, pa.binary())], ["block", "text"])
    tracemalloc.start()
    try:
        assert sum(b.num_rows for b in substrings._anchor_rows(35, 102)(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 60e6
    finally:
        tracemalloc.stop()


def test_bpe(docs, none):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    known = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = bpe.round_trip(docs, path, P.PATTERN).collect()
    want = Counter()
    for key, text in sample():
        ids = array.array("I", known.encode_ordinary(text or "")).tobytes()
        raw = (text or "").encode()
        want[key, len(ids) // 4, ids, raw, hashlib.sha256(ids).hexdigest(), hashlib.sha256(raw).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded), r.ids_sha256, r.decoded_sha256) for r in rows) == want


def test_chunks_meet_at_safe_places():
    portion = bpe._Portion(bpe.exact_pattern(P.PATTERN))
    r = random.Random(1)
    known = bpe.exact_pattern(P.PATTERN)
    texts = ["".join(r.choice(["a", "B", " ", "  ", "\n", "1", "'s", "!", "\u00a0", "é"]) for _ in range(40)) for _ in range(400)]
    for i, text in enumerate(texts):
        portion.add(i, text.encode())
    words = list(portion.words)
    for (_, data), text in zip(portion.texts, texts):
        assert [words[w] for c in np.frombuffer(data, np.int32) for w in portion.lists[c]] == known.findall(text)


def test_bpe_folds_each_word_once():
    """Words that several portions have reach the folds once; each portion is told its own."""
    import pyarrow as pa

    fields = [("portion", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int32()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()), ("data", pa.binary())]
    texts = ["one two  three\x00", "two one four one", "\n" + "five" * 30 + " one \u00e9"]
    rows, words = [], []
    for number, text in enumerate(texts):
        portion = bpe._Portion(bpe.exact_pattern(P.PATTERN))
        portion.add(number, text.encode())
        portion.add(None, b"")
        words.append(set(portion.words))
        rows += portion.rows(pa.schema(fields), number, 3)
    sent = pa.Table.from_batches(rows)
    sent = sent.filter(pa.array([k == 0 for k in sent.column("kind").to_pylist()]))
    schema = pa.schema([("kind", pa.int32()), ("word", pa.string()), ("portion", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary())])
    folded, told = [], defaultdict(set)
    for bucket in range(3):
        own = sent.filter(pa.array([b == bucket for b in sent.column("bucket").to_pylist()]))
        if own.num_rows:
            made = pa.Table.from_batches(bpe._distinct(schema)(bpe._merged(own).to_batches())).to_pylist()
            here = [r["word"] for r in made if r["kind"] == 0]
            folded += here
            for r in made:
                if r["kind"] == 1:
                    told[r["portion"]].update(here[i] for i in bpe._unpacked(r["data"]))
    assert len(folded) == len(set(folded)) and set(folded) == set.union(*words)
    assert [told[n] for n in range(3)] == words


def test_bpe_of_tables_without_words(spark, none):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    empty = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [(r.n_tokens, r.ids_sha256) for r in bpe.round_trip(empty, path, P.PATTERN).collect()] == [(0, hashlib.sha256(b"").hexdigest())] * 2
    assert bpe.round_trip(none, path, P.PATTERN).count() == 0


def test_sharding(docs, none):
    rows = sharding.shard(docs, 7).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((k, size(t), zlib.crc32((t or "").encode())) for k, t in sample())
    place = defaultdict(set)
    texts = defaultdict(list)
    for k, t in sample():
        texts[k].append(t)
    for r in rows:
        if len(texts[r.doc_id]) == 1 or r.doc_id == 409:
            place[texts[r.doc_id][0]].add(r.shard)
    assert all(len(v) == 1 for v in place.values())
    loads, slots = Counter(), defaultdict(list)
    for r in rows:
        loads[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) <= max(1.1 * sum(loads.values()) / 7, max(size(t) for _, t in sample()))
    assert sharding.shard(none).count() == 0


def test_longest_processing_time():
    r = random.Random(3)
    entries = [(r.randrange(1, 1000), i) for i in range(500)]
    place = sharding.lpt(entries, 8)
    loads = Counter()
    for size, entry in entries:
        loads[place[entry]] += size
    assert max(loads.values()) - min(loads.values()) <= 10


def test_language(spark, docs, none):
    letters = {"aa": "abcde", "bb": "defgh", "cc": "klmno"}
    r = random.Random(0)
    make = lambda lang, n: " ".join("".join(r.choice(letters[lang]) for _ in range(6)) for _ in range(n))
    rows = [(i, lang, make(lang, 30)) for i, lang in enumerate(["aa", "bb", "cc"] * 100)] + [(900, None, "zzz"), (901, "aa", None)]
    labelled = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    model = language.fit(labelled, quota=80)
    assert model.languages == ["aa", "bb", "cc"] and (model.weights == 0).mean() > 0.5 and model.temperature > 0
    tests = [make(lang, 20) for lang in letters for _ in range(30)]
    assert np.mean([model.predict(t)[0] == lang for t, lang in zip(tests, [x for x in letters for _ in range(30)])]) > 0.97
    frame = language.predicted(docs, model)
    assert frame.columns == [*docs.columns, "language"]
    got = {r.doc_id: r.language for r in frame.collect()}
    assert got[400] == got[401] == got[402] == ("und", 1.0) and all(0 <= x.score <= 1 for x in got.values())
    nothing = language.fit(none)
    assert nothing.predict("abc") == ("und", 0.0) and language.predicted(none, model).count() == 0


def test_pipeline_without_labels_keeps_texts_with_letters(spark):
    rows = [(1, "clean words", None, "s", 11), (2, "", None, "s", 0), (3, None, None, "s", 0), (4, "12 34 !?", None, "s", 8), (None, "more words", None, "s", 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = corpus_pipeline.identify_language(spark, docs, "")
    want = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    assert sorted(map(tuple, left.collect()), key=str) == sorted(want, key=str)


def test_features_of_pieces_equal_the_whole(monkeypatch):
    text = prose(4, 500) + " ÀÉ日本 x"
    whole = language.counts(text)
    monkeypatch.setattr(language, "PIECE", 97)
    parts = language.counts(text)
    assert all((a == b).all() for a, b in zip(whole, parts))


RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def test_urls(spark):
    given = [
        (1, "http://A.Example.ORG/es/1?x=1"), (2, "https://example.org/en/123#a"), (3, "https://example.org/en/2"), (4, "http://x.com/de/"),
        (5, "http://x.com/fr/3"), (6, "http://com/de/x"), (7, "http://xcom/de/x"), (8, None), (9, "no scheme"), (10, "http://badexample.org/es/"),
        (11, "http://x.org"), (12, "http://x.net?u=a://b/c"), (13, ""), (14, "a://b://c/d"), (None, "http://y.com/en/7?a=1&b=2"), (4, "http://x.com/de/"),
    ]
    pages = spark.createDataFrame([(k, u, "h", "clash") for k, u in given], "page_id long, url string, host string, label string")
    rows = urls.judge(pages, RULES).collect()

    def brute(url):
        if url is None or "://" not in url:
            return "", "", None
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
        best = None
        for _, rule in RULES:
            own, _, start = rule.partition("/")
            if (host == own or host.endswith("." + own)) and path.startswith("/" + start) and len(rule) > len(best or ""):
                best = rule
        return host, path, best

    assert Counter((r.page_id, r.host, r.path, r.rule) for r in rows) == Counter((k, *brute(u)) for k, u in given)
    says = {rule: v for v, rule in RULES}
    assert all(r.verdict == says[r.rule] for r in rows if r.rule) and {r.verdict for r in rows} <= {"allow", "block"}
    assert urls.judge(pages.limit(0), RULES).count() == 0


def test_url_model_learns(spark):
    r = random.Random(2)
    rows = []
    for i in range(600):
        bad = i % 2
        tail = "".join(r.choice("0123456789") for _ in range(20)) if bad else "story/about/words"
        rows.append((i, f"http://h{i}.{'com' if i % 3 else 'net'}/{'de' if bad else 'fr'}/{tail}"))
    got = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), RULES).where("rule is null").collect()
    assert np.mean([(x.verdict == "block") == (x.page_id % 2 == 1) for x in got]) > 0.95


def test_every_suffix_counts(spark, monkeypatch):
    monkeypatch.setattr(urls, "RARE", 4)
    hosts = [f"http://a{i}.site{i % 50}.com/{'de' if i % 50 < 25 else 'fr'}/x" for i in range(1000)] + ["http://big.org/x"] * 3000
    hosts += [f"http://www.site{i}.com/other" for i in range(50)] + [f"http://www.new{i}.com/other" for i in range(50)] + ["http://b.hot.net/x"] * 5000
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(hosts)], "page_id long, url string")
    rows = {r.page_id: r for r in urls.judge(pages, RULES).collect()}
    assert len(rows) == len(hosts)
    verdicts = [rows[4000 + i].verdict for i in range(50)]
    assert verdicts == ["block"] * 25 + ["allow"] * 25


def test_suffix_statistics_equal_brute_force(spark, monkeypatch):
    r = random.Random(5)
    given = [(i, f"http://u{i}", h, r.choice(["block", "allow", None])) for i, h in enumerate(r.choice(["a.b", "c.b", "d", "e.f", "", f"x{j}.b"]) for j in range(300))]
    tail = lambda h, k: ".".join(h.split(".")[-k:])
    frame = spark.createDataFrame([(i, u, v, tail(h, 1), tail(h, 2)) for i, u, h, v in given], "id long, url string, says string, suffix_1 string, suffix_2 string")
    want = {}
    for i, _, h, _ in given:
        want[i] = tuple(x for k in (1, 2) for v in [[v for _, _, o, v in given if tail(o, k) == tail(h, k) and v]] for x in (len(v), v.count("block")))
    for rare in (1, 8, 1000):
        monkeypatch.setattr(urls, "RARE", rare)
        got = urls._with_suffixes(frame).collect()
        assert len(got) == 300 and {x.id: (x.n_1, x.b_1, x.n_2, x.b_2) for x in got} == want
    labelled = frame.where("says is not null").selectExpr("*", "double(says = 'block') AS label")
    known = labelled.withColumn("fold", urls._fold()).collect()
    for x in urls._out_of_fold(labelled, labelled).collect():
        others = [y for y in known if y.suffix_2 == x.suffix_2 and y.fold != x.fold]
        assert (x.n_2, x.b_2) == (len(others), sum(y.label for y in others))


def test_exact(docs, none):
    rows = exact.groups(docs).collect()
    best, size = {}, Counter()
    for k, t in sample():
        size[t or ""] += 1
        best[t or ""] = max((x for x in (best.get(t or ""), k) if x is not None), default=None)
    want = Counter((k, best[t or ""], size[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for k, t in sample())
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows) == want
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert len(kept) == len(best) and set(kept.values()) == {1}
    left = exact.survivors(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in left.collect()) == Counter((best[t], t) for t in best)
    assert exact.groups(none).count() == exact.survivors(none).count() == 0


def test_fingerprints(docs, none):
    rows = fingerprints.against_edits(docs).collect()
    ordered = sorted(sample(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    sets = [Counter(fingerprints.paragraphs(t or "")) for _, t in ordered]

    def alike(a: Counter, b: Counter) -> float:
        return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0

    want = Counter()
    for i, (key, text) in enumerate(ordered):
        text, after = text or "", ordered[(i + 1) % len(ordered)][1] or ""
        part = len(text) // 4
        edited = text[: len(text) - part] + after[:part]
        near_edited, near_next = alike(sets[i], Counter(fingerprints.paragraphs(edited))), alike(sets[i], sets[(i + 1) % len(sets)])
        want[key, len(text), hashlib.sha256(edited.encode()).hexdigest(), round(near_edited, 9), round(near_next, 9)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in rows) == want
    by = defaultdict(set)
    texts = dict(sample())
    for r in rows:
        if r.doc_id not in (None, 409):
            by[texts[r.doc_id] or ""].add(r.fingerprint)
    assert all(len(v) == 1 for v in by.values())
    assert fingerprints.against_edits(none).count() == 0


def test_peeling_recovers_the_difference():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 1 << 62, 5000, dtype=np.uint64))
    b = np.concatenate([a[10:], np.unique(r.integers(0, 1 << 62, 7, dtype=np.uint64))])
    one = np.array([0])
    x, y = fingerprints.sketched([a], one, 16, 0), fingerprints.sketched([b], one, 16, 0)
    plus, less, failed = x.minus(y).peel()
    assert (plus[0], less[0], failed[0]) == (10, 7, False)
    assert fingerprints.likeness([a], [b], x, y)[0] == pytest.approx((len(a) - 10) / (len(a) + 7))


def shingle_sets(rows):
    found = []
    for _, text in rows:
        w = SPLIT.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        found.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    return found


@pytest.mark.parametrize("large", [near.LARGE, 2])
def test_near(docs, none, monkeypatch, large):
    monkeypatch.setattr(near, "LARGE", large)
    monkeypatch.setattr(near, "OUTER", 3)
    monkeypatch.setattr(near, "INNER", 4)
    rows = [(i, t) for i, (_, t) in enumerate(sample())]
    sets, parent = shingle_sets(rows), list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    frame = docs.sparkSession.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, node string")
    got = near.label(frame).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got) == Counter((i, len(sets[i]), root(i), root(i) == i) for i, _ in rows)
    assert near.label(docs).count() == len(rows) and near.label(none).count() == 0


@pytest.mark.parametrize("large", [near.LARGE, 2])
def test_links_that_avoid_the_representative(spark, monkeypatch, large):
    """A chain of versions: neighbours are alike, the ends are not."""
    monkeypatch.setattr(near, "LARGE", large)
    words = prose(9, 400).split()
    rows = [(i, " ".join(words[i * 8 : i * 8 + 100])) for i in range(30)]
    got = near.label(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.component_id for r in got} == {0}


def test_sketches_estimate_similarity():
    r = np.random.default_rng(5)
    base = np.unique(r.integers(0, 1 << 63, 400, dtype=np.uint64))
    for share in (0.5, 0.75, 0.9):
        n = len(base)
        k = int(n * (1 - share) / (1 + share))
        pool = [np.sort(np.concatenate([base[: n - k], np.unique(r.integers(0, 1 << 63, k, dtype=np.uint64))])) for _ in range(20)]
        made = near.sketch(np.concatenate([base, *pool]), np.cumsum([len(base), *map(len, pool)]))
        assert (made != np.iinfo(np.uint64).max).all()
        assert np.mean([(made[0] == m).mean() for m in made[1:]]) == pytest.approx(1 - 2 * k / (n + k), abs=0.05)
    tiny = near.sketch(np.array([1, 2, 2], np.uint64), np.array([2, 3]))
    assert (tiny != np.iinfo(np.uint64).max).all()


def test_peeling_ends_with_a_foreign_value():
    """A value whose check is right, in a cell that is not its own, is no member."""
    made = fingerprints.Sketches(1, 16)
    values = fingerprints.mix(np.arange(1, 4, dtype=np.uint64))
    made.add(np.zeros(3, np.int64), values)
    foreign = fingerprints.mix(np.array([99], np.uint64))
    own = {int(a[0]) for a in made._at(np.zeros(1, np.int64), foreign)}
    wrong = next(i for i in range(made.width) if made.count[i] == 0 and i not in own)
    made.count[wrong], made.value[wrong], made.check[wrong] = 1, foreign[0], fingerprints._check(foreign)[0]
    plus, less, failed = made.peel()
    assert failed.tolist() == [True] and plus[0] == 3 and less[0] == 0


def test_temperature_lies_inside_its_range():
    r = np.random.default_rng(0)
    labels = r.integers(0, 4, 4000)
    logits = r.normal(0, 1, (4000, 4)) * 6
    logits[np.arange(4000), labels] += 9  # three times too sure
    heat = language.temperature(logits, labels)
    assert 1 < heat < 49
    z = logits / heat
    p = np.exp(z - z.max(axis=1, keepdims=True))
    p /= p.sum(axis=1, keepdims=True)
    best, right = p.max(axis=1), p.argmax(axis=1) == labels
    for low, high in ((0.4, 0.6), (0.6, 0.8), (0.8, 0.95)):  # scores are the share of right answers
        some = (best >= low) & (best < high)
        assert some.sum() > 50 and abs(best[some].mean() - right[some].mean()) < 0.12
    assert language.temperature(np.eye(4)[labels] * 100, labels) >= 1


def test_unseen_scripts_score_chance(spark):
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.fit(given.where(~language.held_out("doc_id")))
    known = given.where(language.held_out("doc_id")).where("lang IS NOT NULL").collect()
    least = corpus_pipeline.ABOVE_CHANCE / len(model.languages)
    assert all(model.predict(r.text)[0] == r.lang for r in known)
    assert all(model.predict(r.text)[1] >= least for r in known)
    for text in ("日本語のテキストです。これは東京で書かれました。", "Это русский текст о погоде", "안녕하세요 세계", "مرحبا بالعالم كيف حالك", "Ελληνικό κείμενο"):
        assert model.predict(text)[1] < least


def near_rows() -> list[tuple]:
    text = prose(70, 120)
    rows = [(5, text, "en", "s", 1), (3, text + " end", "en", "s", 1), (3, prose(71, 90), "en", "s", 1), (None, text + " more", "en", "s", 1)]
    rows += [(None, prose(72, 80), "en", "s", 1), (None, prose(72, 80) + " x", "en", "s", 1), (8, None, "en", "s", 1), (8, " ", "en", "s", 1), (9, None, None, None, None)]
    return rows + [(11, prose(73, 60), "en", "s", 1), (11, prose(73, 60), "en", "s", 1), (11, prose(73, 60), "fr", "s", 2)]


def test_near_copies_go_by_row(spark):
    """Equal and null ids: one row of each component stays, and rows without words."""
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = near_rows()
    docs = spark.createDataFrame(rows, schema).repartition(2)
    got = Counter(tuple(r) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect())
    assert got == Counter([rows[1], rows[2], rows[6], rows[7], rows[8], rows[11], min(rows[4:6], key=lambda r: hashlib.sha256(r[1].encode()).digest())])
    none = spark.createDataFrame([], schema)
    assert corpus_pipeline.drop_near_copies(spark, none, "").count() == 0


def test_near_labels_of_other_kinds_of_ids(spark):
    for kind in ("int", "string", "decimal(10,0)"):
        docs = spark.createDataFrame([(i, prose(9, 50)) for i in range(3)], "doc_id long, text string")
        rows = near.label(docs.withColumn("doc_id", docs.doc_id.cast(kind))).collect()
        assert {str(r.component_id) for r in rows} == {"0"} and sum(r.kept for r in rows) == 1
