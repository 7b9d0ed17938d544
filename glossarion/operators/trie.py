"""Ordered-dictionary operators as joins over a prefix table, and a compact binary encoding."""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

MAGIC, VERSION = b"GLTR", 1


def nodes(words: DataFrame) -> DataFrame:
    """One row for each distinct prefix: prefix, parent, depth, terminal."""
    cut = words.select("id", F.explode(F.sequence(F.lit(1), F.length("id"))).alias("depth")).where("length(id) > 0")
    p = cut.select(F.substr("id", F.lit(1), F.col("depth")).alias("prefix"), "depth", (F.length("id") == F.col("depth")).alias("t"))
    return p.groupBy("prefix", "depth").agg(F.bool_or("t").alias("terminal")).withColumn("parent", F.substr("prefix", F.lit(1), F.col("depth") - 1))


def has(words: DataFrame, asked: DataFrame) -> DataFrame:
    return asked.join(words.select("id").distinct(), "id", "left_semi")


def with_ids(words: DataFrame) -> DataFrame:
    """node_id: the word's place by length, then code points, as an uncompressed level-order trie numbers its words."""
    # numbered within a length and the first two letters; the groups' totals are summed and joined back
    per = words.select("id").distinct().withColumns({"len": F.length("id"), "p": F.substring("id", 1, 2)})
    totals = per.groupBy("len", "p").agg(F.count("*").alias("c"))
    before = totals.withColumn("b", F.sum("c").over(W.orderBy("len", "p").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("c")).drop("c")
    return per.withColumn("k", F.row_number().over(W.partitionBy("len", "p").orderBy("id")) - 1).join(before, ["len", "p"]).select("id", (F.col("b") + F.col("k")).alias("node_id"))


def words_of_ids(words: DataFrame, asked: DataFrame) -> DataFrame:
    """The word of each asked node_id; an id that no word has gives no row."""
    return with_ids(words).join(asked.select("node_id").distinct(), "node_id")


def keys_with_prefix(words: DataFrame, prefix: str, limit: int = 100) -> DataFrame:
    return words.where(F.col("id").startswith(prefix)).select("id").orderBy("id").limit(limit)


def common_prefixes(words: DataFrame, texts: DataFrame) -> DataFrame:
    """Words that begin each text, by an equality join on the text's prefixes."""
    cut = texts.distinct().select("text", F.explode(F.transform(F.sequence(F.lit(1), F.length("text")), lambda n: F.substr("text", F.lit(1), n))).alias("id"))
    return cut.join(words.select("id").distinct(), "id")


def longest_prefix(words: DataFrame, texts: DataFrame) -> DataFrame:
    """The longest prefix of each text that some word has; none: no row."""
    cut = texts.distinct().select("text", F.explode(F.transform(F.sequence(F.lit(1), F.length("text")), lambda n: F.substr("text", F.lit(1), n))).alias("prefix"))
    return cut.join(nodes(words).select("prefix"), "prefix", "left_semi").groupBy("text").agg(F.max_by("prefix", F.length("prefix")).alias("prefix"))


def next_letters(words: DataFrame, prefix: str) -> DataFrame:
    n = len(prefix)
    rest = words.where(F.col("id").startswith(prefix) & (F.length("id") > n))
    return rest.groupBy(F.substring("id", n + 1, 1).alias("letter")).agg(F.count("*").alias("n"))


def children(words: DataFrame, prefix: str) -> DataFrame:
    return nodes(words).where(F.col("parent") == prefix).select("prefix", "terminal")


def neighbors(words: DataFrame) -> DataFrame:
    """Word before and after each word. Ranges of first letters are ordered apart; their edges, two rows each, are joined back."""
    ranged = words.distinct().withColumn("__r", F.substring("id", 1, 2))
    w = W.partitionBy("__r").orderBy("id")
    inner = ranged.withColumn("before", F.lag("id").over(w)).withColumn("after", F.lead("id").over(w))
    edges = ranged.groupBy("__r").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
    e = W.orderBy("__r")
    edges = edges.select("__r", F.lag("hi").over(e).alias("__b"), F.lead("lo").over(e).alias("__a"))
    return inner.join(edges, "__r").select("id", F.coalesce("before", "__b").alias("before"), F.coalesce("after", "__a").alias("after"))


def random_words(words: DataFrame, n: int, seed: int = 0) -> DataFrame:
    return words.select("id").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(n)


class BitVector:
    """rank and select in constant and logarithmic time over packed bits; select counts from 1, -1 if out of range."""

    def __init__(self, bits: np.ndarray):
        self.bits = np.asarray(bits, bool)
        self.ones = np.concatenate([[0], np.cumsum(self.bits)])

    def rank1(self, i: int) -> int:
        return int(self.ones[i])

    def rank0(self, i: int) -> int:
        return i - int(self.ones[i])

    def select1(self, k: int) -> int:
        return int(np.searchsorted(self.ones, k)) - 1 if 1 <= k <= self.ones[-1] else -1

    def select0(self, k: int) -> int:
        zeros = np.arange(len(self.ones)) - self.ones
        return int(np.searchsorted(zeros, k)) - 1 if 1 <= k <= zeros[-1] else -1


class Trie:
    """Level-order unary degree sequence with labels and word ends, for a driver-sized word list."""

    def __init__(self, louds: np.ndarray, labels: str, terminal: np.ndarray):
        self.louds, self.labels, self.ends = BitVector(louds), labels, BitVector(terminal)

    @classmethod
    def build(cls, words) -> Trie:
        level, louds, labels, terminal = [sorted(set(words))], [True, False], [], []
        depth = 0
        while level:
            below = []
            for group in level:
                here = group and len(group[0]) == depth
                terminal.append(bool(here))
                rest = group[1:] if here else group
                starts = [i for i, w in enumerate(rest) if not i or rest[i - 1][depth] != w[depth]]
                for a, b in zip(starts, [*starts[1:], len(rest)]):
                    below.append(rest[a:b])
                    labels.append(rest[a][depth])
                louds += [True] * len(starts) + [False]
            level, depth = below, depth + 1
        return cls(np.array(louds, bool), "".join(labels), np.array(terminal, bool))

    def _children(self, node: int) -> range:
        begin = self.louds.select0(node + 1) + 1
        end = self.louds.select0(node + 2)
        first = self.louds.rank1(begin)
        return range(first, first + end - begin)

    def _walk(self, text: str) -> int:
        node = 0
        for c in text:
            node = next((k for k in self._children(node) if self.labels[k - 1] == c), -1)
            if node < 0:
                return -1
        return node

    def word_id(self, word: str) -> int:
        node = self._walk(word)
        return self.ends.rank1(node) if node >= 0 and self.ends.bits[node] else -1

    def __contains__(self, word: str) -> bool:
        return self.word_id(word) >= 0

    def word(self, k: int) -> str:
        node, out = self.ends.select1(k + 1), []
        while node > 0:
            out.append(self.labels[node - 1])
            node = self.louds.rank0(self.louds.select1(node + 1)) - 1
        return "".join(reversed(out))

    def with_prefix(self, prefix: str, limit: int = 100) -> list[str]:
        node, out = self._walk(prefix), []
        stack = [(node, prefix)] if node >= 0 else []
        while stack and len(out) < limit:
            n, text = stack.pop()
            if self.ends.bits[n]:
                out.append(text)
            stack += [(k, text + self.labels[k - 1]) for k in reversed(self._children(n))]
        return out

    def common_prefixes(self, text: str) -> list[tuple[str, int]]:
        return [(text[:n], self.word_id(text[:n])) for n in range(1, len(text) + 1) if text[:n] in self]

    def stats(self) -> dict[str, float]:
        n, size = self.ends.rank1(len(self.ends.bits)), len(self.to_bytes())
        return {"words": n, "nodes": len(self.ends.bits), "edges": len(self.labels), "bytes": size, "bits_per_word": 8 * size / max(n, 1)}

    def to_bytes(self) -> bytes:
        labels = self.labels.encode()
        parts = [np.packbits(self.louds.bits).tobytes(), np.packbits(self.ends.bits).tobytes(), labels]
        head = MAGIC + struct.pack("<IIIII", VERSION, len(self.louds.bits), len(self.ends.bits), len(labels), 0)
        return head + b"".join(parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Trie:
        if data[:4] != MAGIC:
            raise ValueError("not a trie file")
        version, n, m, k, _ = struct.unpack("<IIIII", data[4:24])
        if version != VERSION:
            raise ValueError(f"trie version {version}")
        a, b = 24 + (n + 7) // 8, 24 + (n + 7) // 8 + (m + 7) // 8
        bits = lambda x, size: np.unpackbits(np.frombuffer(x, np.uint8))[:size].astype(bool)
        return cls(bits(data[24:a], n), data[b : b + k].decode(), bits(data[a:b], m))


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def read_varint(data: bytes, at: int = 0) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = data[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at
