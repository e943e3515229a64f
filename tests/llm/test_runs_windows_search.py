"""Periodic runs, decontamination and lexical search against plain versions of their definitions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from foliograph.llm import decontamination, lexical_search, periodic_runs, queries
from foliograph.llm.suffix_automaton import SuffixAutomaton
from foliograph.llm.wavelet import WaveletMatrix

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, n_words string, row int, `a b` int, `_id` int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_runs(w, shortest=12):
    """All runs by trying every period at every place."""
    n, found = len(w), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(shortest, 2 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i) + 1
    return sorted((s, e - s, q) for (s, e), q in found.items())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(11)
    vocabulary = ["".join(rng.choice(list("abcdefgh"), rng.integers(1, 7))) for _ in range(300)]

    def prose(n):
        return " ".join(rng.choice(vocabulary, n))

    texts = [prose(int(n)) for n in rng.integers(1, 200, 20)]
    texts += [prose(9) + " " + " ".join([prose(p)] * 4) + "\n" + prose(7) for p in (1, 2, 3, 6, 7, 30)]
    texts += [" ".join(rng.choice(list("ab"), 300)), " ".join("a" * 400), " ".join(("a b a b a b a b a " * 2 + "c ") * 20)]
    texts += ["", None, "  \n", "a", "a b c", "Ü, É! " * 9, "x-1 Y_2 漢字 ÀB", prose(4000), " ".join([prose(1500)] * 2), "w" * 5000]
    texts += [texts[0], texts[0].upper(), texts[1] + ".", prose(30) + " " + texts[2] + " " + prose(10)]
    made = [(i, t, "en", "n", 1, 2, 3) for i, t in enumerate(texts)]
    return made + [made[3], made[3], (None, texts[0], None, None, None, None, None), (None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def benchmark(spark, rows):
    """Items that documents hold whole, in part or not; short ones, copies, nulls and ids that sort as text."""
    long = rows[2][1]
    texts = [long, " ".join(words(long)[:14]), "no such words in any of the texts here at all", rows[0][1], rows[0][1]]
    texts += ["a", "a b", "ab a", "", None, "É ü", " ".join(words(rows[36][1])[5:2400]), " ".join("a" * 30), rows[1][1] + " tail"]
    made = [(i * 7, t, 5, "q") for i, t in enumerate(texts)]
    return spark.createDataFrame([*made, made[0], (None, rows[3][1], 1, "z"), (None, None, 1, None)], "item_id long, text string, score int, query string")


def counted(df):
    return collections.Counter(map(tuple, df.collect()))


def test_wavelet_matrix():
    rng = np.random.default_rng(1)
    values = rng.permutation(500)
    matrix = WaveletMatrix(values, 500)
    low = rng.integers(0, 500, 300)
    high = np.array([rng.integers(a, 501) for a in low])
    x = rng.integers(0, 501, 300)
    assert matrix.count_less(low, high, x).tolist() == [int((values[a:b] < v).sum()) for a, b, v in zip(low, high, x)]
    some = np.flatnonzero(high > low)
    k = np.array([rng.integers(0, high[i] - low[i]) for i in some])
    want = [int(np.sort(values[low[i] : high[i]])[j]) for i, j in zip(some, k)]
    assert matrix.quantile(low[some], high[some], k).tolist() == want


@pytest.mark.parametrize("seed", range(40))
def test_runs_of_random_words(seed):
    """Few letters, repeated and nested stretches: every run and no other."""
    rng = np.random.default_rng(seed)
    texts = []
    for _ in range(12):
        w = rng.integers(0, rng.integers(1, 4) + 1, rng.integers(0, 60)).tolist()
        for _ in range(rng.integers(0, 4)):
            a, b = sorted(rng.integers(0, len(w) + 1, 2).tolist())
            w = w[:b] + w[a:b] * int(rng.integers(0, 4)) + w[b:]
        texts.append(w[:400])
    first = np.cumsum([0, *map(len, texts)])
    flat = np.array([x for t in texts for x in t], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    text, start, stop, period = periodic_runs.text_runs(flat, first)
    got = [[] for _ in texts]
    for t, s, e, q in zip(text.tolist(), start.tolist(), stop.tolist(), period.tolist()):
        got[t].append((s - int(first[t]), e - s, q))
    assert got == [plain_runs(w) for w in texts]


def plain_digest(key, text):
    w = words(text)
    runs = plain_runs(w)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    exponent = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    return key, len(runs), *best, exponent, sha(lines), sha(kept)


def test_periodic_runs(docs, rows, empty):
    got = periodic_runs.run_digests(docs)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert counted(got) == collections.Counter(plain_digest(r[0], r[1]) for r in rows)
    assert periodic_runs.run_digests(empty).count() == 0


def test_runs_in_chunks_and_slices(docs, rows, monkeypatch):
    monkeypatch.setattr(periodic_runs, "CHUNK", 7)
    for row in rows[20:36]:
        w = words(row[1])
        number = {x: i for i, x in enumerate(dict.fromkeys(w))}
        flat = np.array([number[x] for x in w], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        _, start, stop, period = periodic_runs.text_runs(flat, np.array([0, len(w)]))
        assert list(zip(start.tolist(), (stop - start).tolist(), period.tolist())) == plain_runs(w)


def test_listed_runs_and_collapsed_texts(docs, rows, empty):
    want = collections.Counter(
        (r[0], s, n, q, " ".join(words(r[1])[s : s + q])) for r in rows for s, n, q in plain_runs(words(r[1]))
    )
    assert counted(periodic_runs.runs(docs)) == want
    made = periodic_runs.collapsed(docs)
    assert made.columns == docs.columns and made.dtypes == docs.dtypes

    def plain(text):
        w = words(text)
        runs = plain_runs(w)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        return " ".join(x for i, x in enumerate(w) if i not in gone) if runs else text

    assert counted(made) == collections.Counter((r[0], plain(r[1]), *r[2:]) for r in rows)
    assert periodic_runs.runs(empty).count() == 0 and periodic_runs.collapsed(empty).count() == 0


def test_planted_periods(docs, rows):
    def planted(key, text):
        h = zlib.crc32(str(key).encode()) if key is not None else 1
        w, g = words(text), h // 10
        if h % 10 or not w:
            return key, w
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        return key, [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]

    got = [(r["doc_id"], words(r["text"])) for r in queries.with_planted_periods(docs).collect()]
    assert sorted(map(repr, got)) == sorted(repr(planted(r[0], r[1])) for r in rows)


@pytest.mark.parametrize("seed", range(10))
def test_suffix_automaton(seed):
    rng = np.random.default_rng(seed)
    sequences = [rng.integers(0, 3, rng.integers(0, 15)).tolist() for _ in range(6)]
    automaton = SuffixAutomaton(sequences, 3)
    held = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    streams = [rng.integers(-1, 4, 40).tolist() for _ in range(5)]
    state, length = np.zeros(5, np.int32), np.zeros(5, np.int32)
    for step in range(40):
        automaton.advance(state, length, np.array([s[step] if s[step] < 3 else -1 for s in streams], np.int64))
        for s, n in zip(streams, length.tolist()):
            read = s[: step + 1]
            assert n == max((k for k in range(step + 2) if k == 0 or tuple(read[step + 1 - k :]) in held))


def item_windows(benchmark, window=10):
    found = collections.defaultdict(set)
    for r in benchmark.collect():
        t = terms(r["text"])
        for i in range(max(len(t) - window + 1, min(len(t), 1))):
            found[tuple(t[i : i + window])].add(r["item_id"])
    return found


def plain_hits(text, found):
    t, hit, items = terms(text), set(), set()
    for m in {len(k) for k in found}:
        for i in range(len(t) - m + 1):
            if (k := tuple(t[i : i + m])) in found:
                hit |= set(range(i, i + m))
                items |= found[k] - {None}
    return t, hit, items


@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 900])
def test_decontamination(docs, rows, benchmark, empty, block_words, monkeypatch):
    monkeypatch.setattr(decontamination, "LANE", 50)
    monkeypatch.setattr(decontamination, "PIECE", 300)
    want = collections.Counter()
    found = item_windows(benchmark)
    for key, text, *_ in rows:
        t, hit, items = plain_hits(text, found)
        want[key, len(t), len(hit), len(items), sha(",".join(sorted(map(str, items)))), bool(hit)] += 1
    got = decontamination.contamination(docs, benchmark, block_words=block_words)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert counted(got) == want
    assert decontamination.contamination(empty, benchmark, block_words=block_words).count() == 0


def test_decontamination_without_items(docs, rows, benchmark):
    got = decontamination.contamination(docs, benchmark.limit(0))
    assert counted(got) == collections.Counter((r[0], len(terms(r[1])), 0, 0, sha(""), False) for r in rows)


def test_decontamination_without_short_items(docs, rows, benchmark):
    """No item below the window: the words are chosen by four-word sequences."""
    long = benchmark.filter("length(text) > 60")
    found = item_windows(long)
    assert min(map(len, found)) == 10
    got = {r["doc_id"]: (r["n_hit"], r["n_items"]) for r in decontamination.contamination(docs, long).collect()}
    for key, text, *_ in rows[:-2]:
        _, hit, items = plain_hits(text, found)
        assert got[key] == (len(hit), len(items))


@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 900])
def test_decontaminated_texts(docs, rows, benchmark, block_words):
    long = benchmark.filter("length(text) > 60")
    found = item_windows(long)
    want = collections.Counter()
    for key, text, *rest in rows:
        t, hit, _ = plain_hits(text, found)
        if len(hit) > 0.5 * len(t):
            continue
        spans = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))]
        drop = set()
        for i in hit:
            drop |= set(range(spans[i - 1][1] if i - 1 in hit else spans[i][0], spans[i][1]))
        want[key, None if text is None else "".join(c for i, c in enumerate(text) if i not in drop), *rest] += 1
    got = decontamination.decontaminated(docs, long, block_words=block_words)
    assert got.columns == docs.columns and got.dtypes == docs.dtypes
    assert counted(got) == want and sum(want.values()) < len(rows)


def plain_ranking(rows, items, k):
    counts = [(key, collections.Counter(terms(text))) for key, text, *_ in rows]
    counts = [(key, c, sum(c.values())) for key, c in counts if c]
    total, length = len(counts), sum(n for _, _, n in counts)
    df = collections.Counter(x for _, c, _ in counts for x in c)
    want = collections.Counter()
    for item in items:
        scores = []
        for key, c, n in counts:
            m = 75 + 25 * n * total // length
            score = 0
            for x in terms(item["text"]):
                if c[x]:
                    score += math.floor(1000 * math.log((2 * total + 2) / (2 * df[x] + 1))) * (10**9 * c[x] // (1000 * c[x] + 12 * m))
            if score > 0:
                scores.append((-score, key is None, key or 0, key))
        for rank, (score, _, _, key) in enumerate(sorted(scores)[:k], 1):
            want[item["item_id"], rank, key, -score] += 1
    return want


@pytest.mark.parametrize("k, block_terms, shard_docs", [(20, lexical_search.BLOCK_TERMS, 1 << 16), (3, 1500, 5), (1, 200, 2)])
def test_lexical_search(docs, rows, benchmark, k, block_terms, shard_docs, monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_DOCS", shard_docs)
    got = lexical_search.ranked(docs, benchmark, k, block_terms=block_terms)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert counted(got) == plain_ranking(rows, benchmark.collect(), k)


def test_lexical_search_limits_accumulators():
    """Accumulators stop early, and the best documents are those of full sums."""
    rng = np.random.default_rng(5)
    n, per, share = 4000, 6, np.arange(1, 41) / 820
    held = np.concatenate([rng.choice(40, per, replace=False, p=share) for _ in range(n)]).astype(np.int32)
    df = np.bincount(held, minlength=40)
    asked = [np.array([0, 3, 38, 39, 39], np.uint64)]
    block = lexical_search.Queries(pa.array([1]), asked, np.arange(40, dtype=np.uint64), df, n, n * per, 5)
    shard = lexical_search.Shard(block, np.full(n, per), np.full(n, per), held, rng.integers(1, 9, n * per))
    full = np.zeros(n, np.int64)
    for term, times in zip(*block.terms[0]):
        at = slice(shard.edge[term], shard.edge[term + 1])
        full[shard.doc[at]] += times * shard.gain[at]
    found, score = shard.best(0, 0)
    assert len(found) < (full > 0).sum() / 2
    assert (score == full[found]).all()
    assert sorted(score)[-5:] == sorted(full)[-5:]


def test_lexical_search_empty(docs, benchmark, empty):
    assert lexical_search.ranked(empty, benchmark).count() == 0
    assert lexical_search.ranked(docs, benchmark.limit(0)).count() == 0
    assert lexical_search.ranked(docs, benchmark.filter("text = ''")).count() == 0
