"""The registered queries over whole given tables, against SQL or the long way round."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import corpus_pipeline  # noqa: E402
import plainly  # noqa: E402
import __spark_entry__ as contract  # noqa: E402
from tallyframe.llm.common import read_table, stage  # noqa: E402
from tallyframe.llm.queries import QUERIES, vocabulary  # noqa: E402
from workload.check import as_rows  # noqa: E402


@pytest.fixture(scope="module")
def docs(base):
    return base.execute("SELECT doc_id, text FROM documents").fetchall()


def rows_of(spark, sf_dir, name):
    return QUERIES[name][0](spark, sf_dir).collect()


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {name.split("_")[0] + "_" for name in QUERIES}


@pytest.mark.parametrize("name", [name for name, (_, sql) in QUERIES.items() if sql])
def test_same_rows_as_sql(name, spark, sf_dir, base):
    df = QUERIES[name][0](spark, sf_dir)
    answer = base.execute(QUERIES[name][1])
    names = [column[0] for column in answer.description]
    assert sorted(names) == sorted(df.columns)
    assert as_rows(df.columns, [tuple(row) for row in df.collect()]) == as_rows(names, answer.fetchall())


def test_substring_dedup(spark, sf_dir, docs):
    want = {doc: (n, gone, plainly.sha(left)) for (doc, _), (n, gone, left) in zip(docs, plainly.cut_repeats([t for _, t in docs]))}
    got = {row["doc_id"]: (row["n_words"], row["n_removed"], row["kept_sha256"]) for row in rows_of(spark, sf_dir, "op1_substring_dedup")}
    assert got == want and sum(gone for _, gone, _ in want.values()) > 0


def test_byte_bpe(spark, sf_dir, docs):
    import tiktoken

    vocab = vocabulary("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("t", pat_str=vocab.pattern, mergeable_ranks=vocab.table(), special_tokens={})
    ids = {doc: library.encode_ordinary(text or "") for doc, text in docs}
    want = {doc: (len(i), plainly.sha(np.array(i, "<u4").tobytes()), plainly.sha((dict(docs)[doc] or "").encode())) for doc, i in ids.items()}
    got = {row["doc_id"]: (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) for row in rows_of(spark, sf_dir, "op4_byte_bpe")}
    assert got == want


def test_secrets(spark, sf_dir, docs):
    texts = {doc: ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in plainly.secrets(text)) for doc, text in docs}
    got = {row["doc_id"]: (row["spans"], row["base_sha256"]) for row in rows_of(spark, sf_dir, "op6_secret_ledger")}
    assert got == {doc: (spans, plainly.sha(spans.encode())) for doc, spans in texts.items()}


def test_neighbours(spark, sf_dir, base):
    vectors = dict(base.execute("SELECT vec_id, embedding FROM embeddings").fetchall())
    want = {q: found for q, found in plainly.nearest(vectors, 20).items() if q % 20 == 0}
    got: dict = {}
    for row in sorted(rows_of(spark, sf_dir, "op8_block_neighbours"), key=lambda row: (row["query_id"], row["rank"])):
        got.setdefault(row["query_id"], []).append((-row["score"], row["vec_id"]))
    assert got == want


def test_jaccard_join(spark, sf_dir, docs):
    got = {row["doc_id"]: (row["n_shingles"], row["component_id"]) for row in rows_of(spark, sf_dir, "op9_jaccard_join")}
    assert got == plainly.components(docs)


def test_packing(spark, sf_dir, docs):
    from tokenizers import Tokenizer
    import public_tokenizers

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    want = {
        (doc, piece, *facts)
        for doc, text in docs
        for piece, facts in enumerate(plainly.piece_sums([*library.encode(text or "", add_special_tokens=False).ids, 0], 2048))
    }
    rows = rows_of(spark, sf_dir, "op10_best_fit_packing")
    assert {(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows} == want
    assert well_packed(rows, 2048) <= 1.02 * sum(r["length"] for r in rows) / 2048 + 1


def well_packed(rows, size) -> int:
    """Checks places; returns the number of sequences."""
    sequences: dict = {}
    for row in rows:
        sequences.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences)


def test_periodic_runs(spark, sf_dir, docs):
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {row["doc_id"]: tuple(row[name] for name in names) for row in rows_of(spark, sf_dir, "op12_periodic_runs")}
    want = {doc: plainly.run_digests(doc, text) for doc, text in docs}
    assert got == want and sum(facts[0] > 0 for facts in want.values()) > 10


@pytest.mark.parametrize(
    "name, label, size, least",
    [("op3_line_field", "quality", "0.01", 0.95), ("op7_toxic_terms", "toxic", "0.1", 0.97)],
)
def test_held_out_accuracy(name, label, size, least, spark, base):
    sf_dir = f"/root/testdata/sf{size}"
    labels = dict(base.execute(f"SELECT doc_id, {label} FROM '{sf_dir}/labels.parquet'").fetchall())
    rows = rows_of(spark, sf_dir, name)
    assert all(0 <= row["score"] <= 1 for row in rows)
    assert all(row["predicted"] == int(row["score"] >= (0.3 if label == "quality" else 0.5)) for row in rows)
    held = [row for row in rows if row["held_out"] and row["doc_id"] in labels]
    assert len(held) > 40 and np.mean([row["predicted"] == labels[row["doc_id"]] for row in held]) >= least


def test_pipeline(spark, sf_dir):
    """Each stage against the long way round, on what the stage before it kept."""
    docs = read_table(spark, sf_dir, "documents")
    kept = [docs]
    for name, apply in corpus_pipeline.STAGES:
        kept.append(stage(apply(spark, kept[-1], sf_dir), "test-stage"))
    good, single, cut, masked, packed = ([row.asDict() for row in df.collect()] for df in kept[1:])
    whole = [row.asDict() for row in docs.collect()]
    by_id = {row["doc_id"]: row for row in whole}
    scores = {row["doc_id"]: row["predicted"] for row in rows_of(spark, sf_dir, "op3_line_field")}
    assert sorted(row["doc_id"] for row in good) == sorted(doc for doc, keep in scores.items() if keep)
    assert all(row == by_id[row["doc_id"]] for row in good)
    parts = plainly.components([(row["doc_id"], row["text"]) for row in good])
    assert sorted(row["doc_id"] for row in single) == sorted({component for _, component in parts.values()})
    left = {row["doc_id"]: done for row, done in zip(single, plainly.cut_repeats([row["text"] for row in single]))}
    for row in cut:
        _, gone, words = left[row["doc_id"]]
        assert row["text"] == (words.decode() if gone else by_id[row["doc_id"]]["text"])
        assert row["n_chars"] == len(row["text"])
    before = {row["doc_id"]: row["text"] for row in cut}
    for row in masked:
        assert not plainly.secrets(row["text"])
        assert (row["text"] == before[row["doc_id"]]) == (not plainly.secrets(before[row["doc_id"]]))
    assert {row["doc_id"] for row in packed} == {row["doc_id"] for row in masked} == {row["doc_id"] for row in single}
    well_packed(packed, 2048)
