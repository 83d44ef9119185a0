"""Contamination by winnowing, collocations and whitening against plain versions."""

import hashlib

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from daysync.llm import phrases, queries, whiten, winnow, wordcodes

SF_DIR = "/root/testdata/sf0.001"


# Winnowing


def test_any_shared_window_shares_its_fingerprint():
    rng = np.random.default_rng(3)
    for size in (1, 2, 3, 7, 10):
        passage = rng.integers(0, 9, 14)
        words = wordcodes.mix(rng.integers(0, 9, 400).astype(np.uint64))
        for at in (0, 20, 386):
            words[at : at + 14] = wordcodes.mix(passage.astype(np.uint64))
        starts, prints = winnow.fingerprints(words, np.zeros(len(words), np.int64), size)
        own = winnow.fingerprints(wordcodes.mix(passage.astype(np.uint64)), np.zeros(14, np.int64), size)[1]
        found = dict(zip(starts.tolist(), prints.tolist(), strict=True))
        for at in (0, 20, 386):
            assert [found[at + k] for k in range(14 - size + 1)] == own.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab1é \x00\n-Z", max_size=30), max_size=6))
def test_words_of_a_block(texts):
    known = wordcodes.WordCodes()
    codes, hashes, rows = winnow._hashed(known, [t.encode() for t in texts])
    expected = [(k, w) for k, t in enumerate(texts) for w in brute.benchmark_words(t)]
    assert [(k, known.words[c].decode()) for k, c in zip(rows.tolist(), codes.tolist(), strict=True)] == expected
    assert len(set(hashes.tolist())) == len({w for _, w in expected})


ITEMS = [
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps for a while"),
    (1, "The quick brown fox jumps over the lazy dog and then it sleeps for a while"),
    (2, "brown fox jumps over the lazy dog and then it barks"),  # shares windows with the first
    (3, "short item here"),
    (4, "one"),
    (5, None),
    (6, " .,- "),
    (10, "ñandú 12 étÉ a b c d e f g h i j k"),
    (None, "an item without any id that still has more than ten words in it"),
    (11, "w w w w w w w w w w w w"),
]
PAGES = [
    (1, "intro THE QUICK brown, fox jumps over the lazy dog and then it sleeps outro"),
    (2, "a Short-item HERE, and one? One more"),
    (3, None),
    (4, ""),
    (5, "quick brown fox jumps over the lazy dog and"),  # nine words of a window only
    (6, "w " * 300),
    (7, "x " * 50_000 + "ñandú 12 étÉ a b c d e f g h i j k " + "y " * 50_000),
    (7, "x " * 50_000 + "ñandú 12 étÉ a b c d e f g h i j k " + "y " * 50_000),
    (7, "the same id with other words"),
    (None, "an item without any id that still has more than ten words in it"),
    (9, "\x00\x01 \t\n"),
    (10, "z" * 300_000),
]
ROWS = "doc_id long, text string, n_words string, exact int, items string, near string, window string, lang string"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(k, t, "n", 1, "i", "m", "w", "en") for k, t in PAGES], ROWS).repartition(3)


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame([(k, t, 0) for k, t in ITEMS], "item_id long, text string, print int")


def test_contaminated(spark, pages, bench):
    found = sorted(map(str, ((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in winnow.contaminated(pages, bench).collect())))
    assert found == sorted(map(str, ((k, *brute.contaminated(t, ITEMS, 10)) for k, t in PAGES)))
    for size in (1, 4):
        found = sorted(map(str, ((r["id"], r["n_words"], r["n_hit"], r["items"]) for r in winnow.contaminated(pages, bench, size=size).collect())))
        assert found == sorted(map(str, ((k, *brute.contaminated(t, ITEMS, size)) for k, t in PAGES)))


def test_contaminated_of_empty_tables(pages, bench):
    assert winnow.contaminated(pages.limit(0), bench).collect() == []
    clean = winnow.contaminated(pages, bench.limit(0)).collect()
    assert len(clean) == len(PAGES) and all(r["n_hit"] == 0 and r["items"] == [] for r in clean)


def test_contaminated_without_a_broadcast(spark, pages, bench):
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = {(r["id"], r["n_hit"]) for r in winnow.contaminated(pages, bench).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert found == {(k, brute.contaminated(t, ITEMS, 10)[1]) for k, t in PAGES}


# Collocations

TALK = [
    ("en", "New York City is big. New York City is far, new york is old"),
    ("en", "New York City is big! new\tyork city: is"),
    ("de", "New York ist groß"),
    (None, "new york new york new york"),
    ("und", "New York"),
    ("en", None),
    ("en", ""),
    ("fr", "a a a a a a a a a a a a"),
    ("fr", "a\x01b c a\x01b c a b c a\x01b c 'a'  a c"),
    ("de", "wort " * 20_000 + "x" * 100_000),
    ("de", "wort " * 20_000 + "x" * 100_000),
]


@pytest.fixture(scope="module")
def talk(spark):
    rows = [(k, lang, t, "p", 1, "w") for k, (lang, t) in enumerate(TALK)]
    return spark.createDataFrame(rows, "doc_id long, lang string, text string, phrase string, f int, w1 string").repartition(3)


def _plain(docs, **options):
    return brute.collocations(docs, **({"longest": 4, "least": 2, "percent": 80, "top": 2000, "scale": 2_000_000} | options))


@pytest.mark.parametrize("options", [{}, {"longest": 2}, {"longest": 3, "percent": 100}, {"longest": 6, "top": 3}, {"least": 3}])
def test_collocations(talk, options):
    found = sorted(tuple(r) for r in phrases.collocations(talk, **({"least": 2} | options)).collect())
    assert found == _plain(TALK, **options)


def test_collocations_with_extended_prefixes_and_small_groups(spark, monkeypatch):
    # So small a budget that prefixes of two and of three words are over it; a filter that lets most pass.
    rng = np.random.default_rng(5)
    docs = [("en", " ".join(f"w{x}" for x in rng.geometric(0.35, 60))) for _ in range(40)]
    df = spark.createDataFrame(docs, "lang string, text string").repartition(4)
    plain = _plain(docs, least=3)
    for share, bits, group in ((1, 64, 8), (200, 1 << 16, 1 << 18), (10_000, 1 << 20, 50)):
        monkeypatch.setattr(phrases, "SHARE", share)
        found = phrases.collocations(df, least=3, filter_bits=bits, group=group).collect()
        assert sorted(tuple(r) for r in found) == plain
    assert len(plain) > 100


def test_scores_beyond_64_bits(spark):
    big = 6 * 10**15
    rows = [("en", "a", big + 1), ("en", "b", big), ("en", "a b", big - 1)]
    df = spark.createDataFrame([(*r, len(r[1].split())) for r in rows], "lang string, phrase string, f long, depth int")
    scored = phrases._scored(df, df.where("depth > 1"), 2_000_000).collect()
    assert [r["score"] for r in scored] == [2_000_000 * (big - 1) // (2 * big + 1)]


def test_collocations_of_an_empty_table(talk):
    assert phrases.collocations(talk.limit(0)).collect() == []
    assert phrases.collocations(talk, least=10**9).collect() == []


# Whitening


def _whitened(rows):
    """rows: (id, vector). What the operator returns, by numpy's own eigenvectors."""
    kept = [(k, [int(np.floor(64 * np.float64(c))) + 1_000_000 for c in v]) for k, v in rows]
    x = np.array([v for _, v in kept], np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    centred = fit - sums / n
    e, q = np.linalg.eigh(centred.T @ centred / n)
    e, q = e[::-1][:16], q[:, ::-1][:, :16]
    return kept, n, sums, e, q, np.trace(centred.T @ centred / n), (x - sums / n) @ (q / np.sqrt(e))


def _compare(found, rows):
    kept, n, sums, e, q, trace, plain = _whitened(rows)
    k = len(e)
    assert len(found) == len(rows) * k
    by = {}
    for r in found:
        by.setdefault(r[0], {})[r["component"]] = r
    got = np.array([[by[i][c + 1]["whitened"] for c in range(k)] for i, _ in kept])
    signs = np.sign((got * plain).sum(0))
    assert np.abs(got * signs - plain).max() < 1e-8
    for i, v in kept:
        assert by[i][1]["deviation"] == sum((n * int(a) - int(s)) ** 2 for a, s in zip(v, sums, strict=True))
    assert {r["n"] for r in found} == {n} and {r["identity_error"] for r in found} and found[0]["identity_error"] < 1e-9
    assert all(abs(by[kept[0][0]][c + 1]["explained"] - e[c] / trace) < 1e-12 for c in range(k))


def test_whitening_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding").collect()]
    _compare(queries.op13_chebyshev_whitening(spark, SF_DIR).collect(), rows)


VECTORS = "vec_id long, embedding array<double>, component string, code int, whitened int"


def _vectors(spark, rows):
    return spark.createDataFrame([(k, v, "c", 1, 2) for k, v in rows], VECTORS).repartition(3)


def test_whitening_leaves_out_what_is_no_vector(spark):
    rng = np.random.default_rng(1)
    good = [(k, (rng.standard_normal(20) * (1 + np.arange(20))).tolist()) for k in range(60)]
    good += [(k + 100, v) for k, v in good[:30]]
    bad = [(900, None), (901, []), (902, [None] * 20), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19), (905, [1.0, 2.0])]
    found = whiten.whitened(_vectors(spark, good + bad)).collect()
    _compare(found, good)
    again = whiten.whitened(_vectors(spark, [*good, (None, good[0][1]), good[1]])).collect()
    assert len(again) == 16 * (len(good) + 2) and sum(r["id"] is None for r in again) == 16


def test_whitening_of_few_dimensions_and_none(spark):
    rng = np.random.default_rng(2)
    flat = [(k, [*rng.standard_normal(3).tolist(), 0.5]) for k in range(30)]  # one direction without variance
    found = whiten.whitened(_vectors(spark, flat)).collect()
    assert {r["component"] for r in found} == {1, 2, 3} and len(found) == 90 and found[0]["identity_error"] < 1e-9
    assert whiten.whitened(_vectors(spark, flat[:1] * 3)).collect() == []
    assert whiten.whitened(_vectors(spark, [])).collect() == []
    huge = whiten.whitened(_vectors(spark, [(1, [1e300, 0.0]), (2, [-1e300, 1.0]), (3, [0.0, 1.0])])).collect()
    assert all(r["deviation"] is None for r in huge if r["id"] < 3) and len(huge) >= 3


def test_subspace_finds_what_a_filter_could_miss():
    rng = np.random.default_rng(4)
    q, _ = np.linalg.qr(rng.standard_normal((120, 120)))
    for values in (np.linspace(100, 1, 120), np.r_[np.full(20, 5.0), np.full(100, 4.99)], 2.0 ** -np.arange(120), np.r_[1e9, np.ones(119)]):
        matrix = (q * values) @ q.T
        found, vectors = whiten.subspace(lambda x, m=matrix: m @ x, 120, values.sum(), 16)
        assert np.allclose(found, np.sort(values)[::-1][:16], rtol=1e-9, atol=1e-12 * values.max())
        assert np.abs(vectors.T @ vectors - np.eye(len(found))).max() < 1e-10


def test_contamination_query_digests(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    expected = []
    for k, text in docs:
        n, hit, named = brute.contaminated(text, items, 10)
        expected.append((k, n, hit, len(named), hashlib.sha256(",".join(named).encode()).hexdigest(), hit > 0))
    found = queries.op11_winnow_contamination(spark, SF_DIR)
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(tuple(r) for r in found.select(columns).collect()) == sorted(expected)
