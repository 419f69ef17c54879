"""Every query against a plain version over a whole small table."""

from __future__ import annotations

import collections
import hashlib
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from claimloom.llm import jaccard_join, packing, word_shuffle_bpe
from tests.llm import helpers

pytestmark = pytest.mark.skipif(
    not helpers.SF_DIR.exists(), reason="the driver's tables are absent"
)

QUERIES = entry.queries()
ORACLE = entry.oracle_sql()


def run(spark, name: str) -> list:
    return QUERIES[name](spark, str(helpers.SF_DIR)).collect()


def texts() -> dict[int, str]:
    return {r["doc_id"]: r["text"] or "" for r in helpers.table("documents")}


def u32(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def test_all_operators_and_the_pipeline_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", [n for n in ORACLE if n.startswith("op")])
def test_sql(spark, name):
    duck = duckdb.connect()
    for path in helpers.SF_DIR.glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    meant = duck.execute(ORACLE[name]).df()
    found = QUERIES[name](spark, str(helpers.SF_DIR)).toPandas()
    assert sorted(found.columns) == sorted(meant.columns)
    columns = sorted(found.columns)
    as_rows = [sorted(f[columns].itertuples(index=False, name=None)) for f in (found, meant)]
    assert as_rows[0] == as_rows[1]


def test_op1(spark):
    groups = collections.defaultdict(list)
    for doc_id, text in texts().items():
        groups[helpers.normal(text)].append(doc_id)
    meant = {
        d: (min(ids), len(ids), d == min(ids), hashlib.sha256(t.encode()).hexdigest())
        for t, ids in groups.items()
        for d in ids
    }
    found = {r.doc_id: tuple(r)[1:] for r in run(spark, "op1_exact_dedup")}
    assert found == meant


def test_op2(spark):
    import html
    import re

    meant = {}
    for page in helpers.table("pages"):
        article = re.search(r"<article>(.*)</article>", page["html"] or "", re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", article)
        plain = [html.unescape(re.sub(r"<[^>]*>", " ", b)) for b in blocks]
        kept = [" ".join(b.split()) for b in plain]
        meant[page["page_id"]] = "\n\n".join(b for b in kept if b)
    rows = run(spark, "op2_html_extraction")
    assert {r.page_id: r.text for r in rows} == meant
    assert all(r.n_chars == len(r.text) for r in rows)


def test_op3(spark):
    """No message here quotes another: all stay in the order of their turns."""
    rows = helpers.table("conversations")
    assert not any(line.lstrip().startswith(">") for r in rows for line in r["text"].split("\n"))
    meant = {(r["conv_id"], r["turn"]): (r["role"], r["text"].strip()) for r in rows}
    found = run(spark, "op3_quotation_linking")
    assert {(r.conv_id, r.turn): (r.role, r.text) for r in found} == meant
    assert len(found) == len(rows)
    assert all(r.position == r.turn == r.thread_turn for r in found)
    assert all((r.parent_turn, r.n_quoted, r.n_linked) == (None, 0, 0) for r in found)


def test_op4(spark):
    rows = run(spark, "op4_ngram_jaccard_join")
    all_texts = texts()
    assert {r.doc_id: r.n_shingles for r in rows} == {
        d: len(helpers.shingles(t, 4)) for d, t in all_texts.items()
    }
    assert {r.doc_id: r.component_id for r in rows} == helpers.similar_groups(all_texts, 4, 85)


def test_op5(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    meant, start = {}, 0
    for doc_id, text in sorted(texts().items()):
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 0]
        meant[doc_id] = (start, len(ids), zlib.crc32(u32(ids)))
        start += len(ids)
    assert {r.doc_id: tuple(r)[1:] for r in run(spark, "op5_token_files")} == meant


def test_op6(spark):
    ranks = word_shuffle_bpe._ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    encoding = tiktoken.Encoding(
        "plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    meant = {}
    for doc_id, text in texts().items():
        ids = encoding.encode_ordinary(text)
        plain = hashlib.sha256(text.encode()).hexdigest()
        meant[doc_id] = (len(ids), hashlib.sha256(u32(ids)).hexdigest(), plain)
    assert {r.doc_id: tuple(r)[1:] for r in run(spark, "op6_byte_bpe")} == meant


def check_packing(rows, all_texts: dict[int, str]) -> None:
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = collections.defaultdict(list)
    sequences = collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(all_texts)
    for doc_id, text in all_texts.items():
        ids = [*tokenizer.encode(text, add_special_tokens=False).ids, 2]
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(u32(ids[at : at + r.length]))
            at += r.length
        assert at == len(ids)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.SEQUENCE_TOKENS
    tokens = sum(r.length for r in rows)
    # at most one bin of a group is less than half full
    assert len(sequences) * packing.SEQUENCE_TOKENS <= 1.1 * tokens + 2 * packing.SEQUENCE_TOKENS


def test_op7(spark):
    check_packing(run(spark, "op7_packing"), texts())


def test_op8(spark):
    found = collections.defaultdict(list)
    for r in run(spark, "op8_nearest_neighbours"):
        found[r.query_id].append((r.rank, r.vec_id, r.score))
    rows = [r for r in helpers.table("embeddings") if r["embedding"]]
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], dtype=np.float64)
    assert set(found) == set(ids[ids % 20 == 0].tolist())
    hits = total = 0
    for query, got in found.items():
        scores = vectors @ vectors[ids == query][0]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != query][:20]
        got.sort()
        assert [g[0] for g in got] == list(range(1, len(got) + 1))
        assert sorted(got, key=lambda g: (-g[2], g[1])) == got
        for _, vec_id, score in got:
            assert score == pytest.approx(scores[ids == vec_id][0], abs=1e-12)
        hits += len({g[1] for g in got} & set(ids[order].tolist()))
        total += len(order)
    assert hits >= 0.9 * total


def test_op9_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in run(spark, "op9_quality_classifier")}
    assert set(rows) == set(texts())
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        assert r.predicted == (r.score >= 0.7)
    judged = [
        (rows[row["doc_id"]].predicted, row["quality"])
        for row in helpers.table("labels")
        if rows[row["doc_id"]].held_out
    ]
    right = sum(p == q for p, q in judged)
    assert right >= 0.85 * len(judged)


def test_op10(spark):
    rows = {r.doc_id: r for r in run(spark, "op10_private_data")}
    all_texts = texts()
    assert set(rows) == set(all_texts)
    for doc_id, text in all_texts.items():
        base = helpers.base_spans(text)
        described = [f"{kind}:{start}:{end}" for start, _, kind, end in base]
        r = rows[doc_id]
        kinds = collections.Counter(kind for _, _, kind, _ in base)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            kinds[k] for k in ("email", "ip", "card", "phone")
        )
        assert r.base_sha256 == hashlib.sha256(",".join(described).encode()).hexdigest()
        assert set(described) <= set(r.spans.split(",")) | {""}


def test_pipeline(spark):
    """Each stage against a plain version on what the stage before it kept."""
    docs = spark.read.parquet(str(helpers.SF_DIR / "documents.parquet"))
    before = {r.doc_id: r.text or "" for r in docs.collect()}
    labels = {r["doc_id"]: r["quality"] for r in helpers.table("labels")}
    for name, stage in corpus_pipeline.STAGES:
        result = stage(spark, docs, str(helpers.SF_DIR))
        rows = result.collect()
        if name == "packing":
            check_packing(rows, before)
            break
        assert result.columns == docs.columns
        after = {r.doc_id: r.text for r in rows}
        assert len(after) == len(rows)
        if name == "quality_classifier":
            clean = [d for d, q in labels.items() if q == 1]
            junk = [d for d, q in labels.items() if q == 0]
            assert sum(d in after for d in clean) >= 0.95 * len(clean)
            assert sum(d in after for d in junk) <= 0.5 * len(junk)
        elif name == "exact_dedup":
            firsts = {}
            for d in sorted(before):
                firsts.setdefault(helpers.normal(before[d]), d)
            assert set(after) == set(firsts.values())
        elif name == "ngram_jaccard_join":
            groups = helpers.similar_groups(before, 5, 80)
            assert set(after) == {d for d, g in groups.items() if d == g}
        elif name == "private_data":
            for doc_id, text in after.items():
                if not helpers.base_spans(before[doc_id]) and text != before[doc_id]:
                    assert "[ID]" in text
                assert not helpers.base_spans(text)
        docs = spark.createDataFrame(rows, docs.schema)
        before = after


def test_settings_of_the_pipeline_are_those_of_near_duplicates():
    settings = jaccard_join.Settings(words=5, percent=80)
    assert settings.probe_length(100) == 21
    assert settings.index_length(100) == 12
