"""The codec against the sentencepiece library, for the public BPE model and a small unigram model."""

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from sentencepiece import sentencepiece_model_pb2 as pb

from glossarion.llm import sentencepiece_codec as sc
from glossarion.llm.queries import op10_sentencepiece_codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "two\nlines\t tab", "日本語 ゼロ 😀", "<s> </s> <unk> <0x41>", "▁x a▁b", "nul\0byte x", "é" * 3000, "word " * 5000, "�  x"]


def test_odd_rows(spark):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(ODD)] + [(None, "a  b", 1, "x")] * 2, "doc_id long, text string, ids int, decoded string")
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = sc.decode(sc.encode(df, PATH), PATH).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        if r.text is not None and "▁" in r.text:
            continue
        want = sp.encode(r.text or "")
        assert np.frombuffer(r.ids, "<u4").tolist() == want, r.text
        assert r.parity and bytes(r.decoded).decode() == (r.text or "")
    assert sc.encode(df.limit(0), PATH).count() == 0


def test_query(spark):
    rows = {r.doc_id: r for r in op10_sentencepiece_codec(spark, SF).collect()}
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        r = rows[d.doc_id]
        assert r.n_tokens == len(sp.encode(d.text)) and r.parity and r.round_trip


@pytest.mark.parametrize("fallback", [True, False])
def test_unigram_model(tmp_path, fallback):
    m = pb.ModelProto()
    m.trainer_spec.model_type, m.trainer_spec.byte_fallback = 1, fallback
    m.normalizer_spec.name, m.normalizer_spec.add_dummy_prefix, m.normalizer_spec.remove_extra_whitespaces = "identity", True, True
    add = lambda p, s, k: m.pieces.add(piece=p, score=s, type=k)
    add("<unk>", 0, 2), add("<s>", 0, 3), add("</s>", 0, 3)
    if fallback:
        for b in range(256):
            add(f"<0x{b:02X}>", -20, 6)
    for k, p in enumerate(["▁", "a", "b", "c", "ab", "▁ab", "abc", "▁c", "bc", "ca", "▁abc"]):
        add(p, -1 - 0.37 * k, 1)
    (tmp_path / "m.model").write_bytes(m.SerializeToString())
    c = sc.Codec(str(tmp_path / "m.model"))
    texts = ["abc ab c", "  abca  bcab ", "aé b", "", "cab"]
    import pyarrow as pa

    ids, lens, agree = c.encode(pa.array(texts))
    bounds = np.concatenate([[0], np.cumsum(lens)])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == c.other.encode(texts) and agree.all()


def test_library_decoder_agrees():
    c = sc.Codec(PATH)
    for t in ["Hello there", "日本 x", "tab\tand\nline"]:
        ids = c.other.encode(t)
        raw, _ = c.decode(np.array(ids), np.array([len(ids)]))
        assert raw.tobytes().decode() == c.tokenizer.decode(ids) == c.other.decode(ids) == t


def test_new_chunks_go_to_the_libraries_joined():
    import pyarrow as pa

    c = sc.Codec(PATH)

    class Other:
        """Counts the strings it is given, and encodes another word in place of one."""

        def __init__(self, real):
            self.real, self.strings = real, 0

        def piece_to_id(self, piece):
            return self.real.piece_to_id(piece)

        def encode(self, texts):
            self.strings += len(texts)
            return self.real.encode([t.replace("zebra", "quaggas") for t in texts])

    c.other = Other(c.other)
    texts = [f"word{k} of {k}é zebra" if k == 700 else f"word{k} of {k}é 日本{k}" for k in range(1000)] + ["a  b", "", " "]
    ids, lens, agree = c.encode(pa.array(texts))
    bounds = np.concatenate([[0], np.cumsum(lens)])
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == c.other.real.encode(texts)
    assert np.flatnonzero(~agree).tolist() == [700]
    c.clear()
    c.other.strings = 0
    c.encode(pa.array(texts[:1000]))
    assert c.other.strings < len(c.index) / 10
