"""Queries that SQL cannot express against plain versions, every column on the smallest tables."""

import hashlib
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daysync.llm import html, pii, queries

SF_DIR = "/root/testdata/sf0.001"


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def texts(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]


def test_bpe_digests(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected = Counter()
    for k, text in texts:
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected[k, len(ids), _sha(",".join(map(str, ids))), _sha(library.decode(ids, skip_special_tokens=False))] += 1
    found = queries.op3_bpe_trie(spark, SF_DIR)
    assert _rows(found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == expected


def test_page_texts(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet").select("page_id", "url", "html").collect()
    expected = Counter((p, u, html.render(h), len(html.render(h))) for p, u, h in pages)
    assert _rows(queries.op5_html_layout(spark, SF_DIR).select("page_id", "url", "text", "n_chars")) == expected


def test_personal_data_columns(spark, texts):
    found = {r["doc_id"]: r for r in queries.op9_crf_pii(spark, SF_DIR).collect()}
    assert sorted(found) == sorted(k for k, _ in texts)
    for k, text in texts:
        rules = sorted((a, kind, b) for a, b, kind in pii.rule_spans(text or ""))
        base = [f"{pii.KINDS[kind]}:{a}:{b}" for a, kind, b in rules]
        spans = found[k]["spans"].split(",") if found[k]["spans"] else []
        assert found[k]["base_sha256"] == _sha(",".join(base)) and not Counter(base) - Counter(spans)
        assert [found[k][f"n_{kind}"] for kind in pii.KINDS] == [sum(b.startswith(f"{kind}:") for b in base) for kind in pii.KINDS]


def test_quality_columns(spark, texts):
    found = queries.op10_rule_quality(spark, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(k for k, _ in texts)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert r["predicted"] == int(r["score"] >= 0.3)
