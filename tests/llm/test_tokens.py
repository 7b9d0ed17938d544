"""Token store and packing against the tokenizers library, document by document."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from glossarion.llm import grammar_store, packing
from glossarion.llm._shared import Workspace
from glossarion.llm.queries import op3_grammar_token_store, op7_vector_bin_packing

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = [(0, None), (1, ""), (2, "  \n"), (3, "<|endoftext|> a<|startoftext|>b"), (4, "don't I'LL 3.14 x² y"), (5, "Ünïcode Σίσυφος ΣΑΣ İstanbul é \x1cx"), (6, "a" * 30000), (7, "the " * 9000), (7, "the " * 9000), (None, "no id")]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in ODD], "doc_id long, text string, ids string, start int")


def truth(rows, end):
    t = Tokenizer.from_file(PATH)
    return [(i, t.encode(x or "", add_special_tokens=False).ids + [end]) for i, x in rows]


def test_store_against_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    want, at = {}, 0
    for i, ids in truth(rows, 1):
        want[i] = (at, len(ids), crc(ids))
        at += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op3_grammar_token_store(spark, SF).collect()}
    assert got == want


def test_store_odd_rows(spark, odd):
    path = Workspace(spark, "t").path
    grammar_store.write_token_store(odd, path, PATH)
    got = sorted((r.start, r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in grammar_store.read_token_store(spark, path).collect())
    want = truth(sorted(ODD, key=lambda r: -1 if r[0] is None else r[0]), 1)
    assert [(i, x) for _, i, x in got] == want
    assert [s for s, _, _ in got] == [sum(len(x) for _, x in want[:k]) for k in range(len(want))]


def test_empty_tables(spark, odd):
    path = Workspace(spark, "t").path
    grammar_store.write_token_store(odd.limit(0), path, PATH)
    assert grammar_store.read_token_store(spark, path).count() == 0
    assert packing.pack(odd.limit(0), PATH).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(1)
    for ids in (rng.zipf(1.3, 50000) % 3000, np.zeros(1000), np.zeros(0), np.array([5]), np.tile([1, 2, 3], 5000)):
        ids = ids.astype(np.uint32)
        g = grammar_store.Grammar(*grammar_store.compress(ids))
        assert np.array_equal(g.decode(), ids)
        for a, b in ((0, 1), (len(ids) // 3, len(ids) // 2), (0, len(ids))):
            if b <= len(ids) and a < b:
                assert np.array_equal(g.decode_range(a, b), ids[a:b])
    assert len(grammar_store.compress(np.tile([1, 2, 3], 5000).astype(np.uint32))[2]) < 3000


def check_packing(pieces, want):
    """Every id in one piece; sequences gapless and full, or a power of two long."""
    sequences, documents = {}, {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        documents.setdefault(p.doc_id, []).append(p)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == 4096 or at & (at - 1) == 0
    assert documents.keys() == want.keys()
    for i, ids in want.items():
        at = 0
        for p in sorted(documents[i], key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            assert p.ids_crc32 == crc(ids[at : at + p.length])
            at += p.length
        assert at == len(ids)


def test_packing_against_library(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    check_packing(op7_vector_bin_packing(spark, SF).collect(), dict(truth(rows, 2)))


def test_packing_odd_rows(spark, odd):
    from pyspark.sql import functions as F

    rows = [r for r in ODD if r != (7, "the " * 9000)]
    pieces = packing.pack(odd.where("doc_id is null or doc_id < 7").repartition(2), PATH).withColumn("ids_crc32", F.crc32("ids")).collect()
    check_packing(pieces, dict(truth(rows, 2)))
    assert sum(r.length for r in packing.pack(odd, PATH).collect()) == sum(len(x) for _, x in truth(ODD, 2))


def test_bins_hold_all_limits():
    rng = np.random.default_rng(2)
    bins = packing.Bins((512, 4, 100))
    total = 0
    for k in range(300):
        n = int(rng.integers(1, 900))
        bins.add(k, np.arange(n, dtype=np.uint32), rng.random(n) < 0.3)
        total += n
    seen = 0
    for b in bins.rest():
        assert sum(len(i[2]) for i in b) <= 512 and len(b) <= 4 and sum(int(i[4].sum()) for i in b) <= 100
        seen += sum(len(i[2]) for i in b)
    assert seen == total


def test_short_documents_fill_sequences(spark):
    """No number of documents in a sequence closes it early."""
    df = spark.createDataFrame([(i, "a b") for i in range(5000)], "doc_id long, text string").coalesce(1)
    got = packing.pack(df, PATH).groupBy("sequence_id").sum("length").collect()
    full = sorted((r[1] for r in got), reverse=True)
    assert full[0] == 4096 and all(n == 4096 or n & (n - 1) == 0 for n in full)


def test_limits_of_segments_and_loss(spark):
    """Turns of conversations: answers bear loss. Every limit holds, every id is in one piece."""
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    rows = turns.select(F.xxhash64("conv_id", "turn").alias("doc_id"), "text", "role")
    pieces = packing.pack(rows, PATH, max_tokens=1024, max_segments=12, max_loss_tokens=300, loss=F.col("role") == "assistant").join(rows.select("doc_id", "role").distinct(), "doc_id").collect()
    bins, docs = {}, {}
    for p in pieces:
        b = bins.setdefault(p.sequence_id, [0, 0, 0])
        b[0] += p.length
        b[1] += 1
        b[2] += p.length * (p.role == "assistant")
        docs.setdefault(p.doc_id, []).append((p.start, p.length, p.doc_tokens))
    assert bins and all(n <= 1024 and k <= 12 and x <= 300 for n, k, x in bins.values())
    for parts in docs.values():
        assert sum(n for _, n, _ in set(parts)) == parts[0][2]
    only = packing.pack(rows, PATH, max_tokens=1024, max_loss_tokens=300).groupBy("sequence_id").sum("length").collect()
    assert max(r[1] for r in only) <= 300


def test_documents_by_random_access(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = Workspace(spark, "t").path
    grammar_store.write_token_store(docs, path, PATH)
    ids = sorted(r.doc_id for r in docs.select("doc_id").collect())[3::17]
    whole = {r.doc_id: bytes(r.ids) for r in grammar_store.read_token_store(spark, path).collect()}
    got = {r.doc_id: bytes(r.ids) for r in grammar_store.read_documents(spark, path, [*ids, -5]).collect()}
    assert got == {i: whole[i] for i in ids}


def test_rounds_go_on_until_no_pair_is_frequent():
    ids = (np.random.default_rng(2).zipf(1.4, 60000) % 2000).astype(np.uint32)
    _, _, seq = grammar_store.compress(ids)
    _, n = np.unique(np.stack([seq[:-1], seq[1:]]), axis=1, return_counts=True)
    assert n.max() < 16


def test_known_words_are_held_without_objects():
    import sys

    import pyarrow as pa

    from glossarion.llm.wordids import WordIds

    library, coder = Tokenizer.from_file(PATH), WordIds(PATH)
    words = [f"{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10 % 10]}{'uvwxyz'[k // 100 % 6]}{chr(224 + k // 600)}{'.,;'[k % 3]}" for k in range(10_000)]
    column = pa.array(words)
    coder.encode(column[:10])
    held = sys.getallocatedblocks()
    ids, lens = coder.encode(column)
    assert sys.getallocatedblocks() - held < 5000
    # once more from what is kept, and as strings of wide offsets
    for again in (column, pa.array(words, pa.large_string())):
        assert (coder.encode(again)[0] == ids).all()
    assert ids.tolist() == [i for e in library.encode_batch(words, add_special_tokens=False) for i in e.ids] and lens.sum() == len(ids)
    # long words do not pile up
    for k in range(6):
        coder.encode(pa.array([f"{k}" + "x y" * 5 + "z" * 9_000_000]))
    assert coder.words.nbytes < 50_000_000
