"""Language-model scores from an Elias-Fano n-gram trie.

The model is an interpolated trigram model over all training documents.
Its n-grams are never gathered in one place: documents are dealt into
blocks, each block asks the shards of the n-gram space for the corpus
counts of the n-grams it holds, and builds from the answers the slice of
the trie that its own texts can reach.  A slice is bounded by the block's
text and the model by nothing.

Trie of a slice (levels are flat buffers, see ``eliasfano``):
  level 1  vocabulary: Elias-Fano sequence of word hashes; the place is the word id
  level 2  seen bigrams, ordered by (first, second): first * V + second
  level 3  seen trigrams, ordered by (bigram of words 1-2, word 3), word 3
           written relative to its context: its rank among the successors
           of word 2 in level 2; prefix sums of those successor counts make
           the sequence monotone
  pointers Elias-Fano, from a word to its first bigram
Each entry holds a quantised log10 probability (uint16, steps of 1/2048)
and each context a quantised back-off weight (uint8 bucket, see below).

Smoothing: p(w|h) = (1 - b) c(hw)/c(h) + b p(w|h'), where b is the share
of training tokens, among contexts of about h's frequency, whose n-gram is
seen once (Good-Turing's unseen mass).  Both "once" and the frequency are
corpus counts: after the shards have answered, each block tallies its own
training tokens under them, and the tallies are summed before any text is
scored.  p(w) is the base (c + 0.5) / (N + 0.5 (V + 1)).  Contexts never
seen have b = 1.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chanlytics.llm import blocks as B
from chanlytics.llm import packets as P
from chanlytics.llm.eliasfano import EliasFano
from chanlytics.llm.words import LOWER, NOT_SPACE, Words, join_hash

_STEP = 2048.0
_END = np.uint64(0x656E64)  # of the end token; word hashes are mixed, so meeting it is as likely as any collision
_BUCKETS = 48
_ORDERS = 3

_PACKET = "shard int, block int, payload binary"
_TALLY = "cell int, tokens long, once long"
_SCORES = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
           "base_score double, score double")


def _factorize(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    import pandas as pd

    place, distinct = pd.factorize(x)
    return place, distinct


class Block:
    """Tokens of a block's documents and their distinct n-grams.

    Words have local ids by hash order; V stands for the begin of a text.
    """

    def __init__(self, table: pa.Table):
        words = Words(table.column("text"), NOT_SPACE, LOWER)
        docs = len(words.count)
        self.lengths = words.count + 1
        total = len(words.hash) + docs
        hashes = np.full(total, _END)
        ends = np.cumsum(self.lengths) - 1
        hashes[np.arange(len(words.hash)) + words.doc_of_word()] = words.hash
        place, distinct = _factorize(hashes)
        order = np.argsort(distinct)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.vocabulary = distinct[order]
        self.V = len(order)
        self.ids = rank[place]
        self.doc = np.repeat(np.arange(docs, dtype=np.int32), self.lengths)
        self.train = np.repeat(~table.column("flag").to_numpy(), self.lengths) if docs else np.zeros(0, bool)
        # bigrams: (previous word or begin, word)
        before = np.empty(total, np.int64)
        before[1:] = self.ids[:-1]
        begins = np.concatenate([[0], ends[:-1] + 1]) if docs else np.zeros(0, np.int64)
        before[begins] = self.V
        self.base = self.V + 1
        self.bi_of, pairs = _factorize(before * self.base + self.ids)
        self.first, self.second = pairs // self.base, pairs % self.base
        # trigrams: (bigram one place back, word); none for a text's first token
        back = np.empty(total, np.int64)
        back[1:] = self.bi_of[:-1]
        self.has_tri = np.ones(total, bool)
        self.has_tri[begins] = False
        at = np.flatnonzero(self.has_tri)
        of, triples = _factorize(back[at] * self.base + self.ids[at])
        self.tri_of = np.full(total, -1, np.int64)
        self.tri_of[at] = of
        self.context, self.third = triples // self.base, triples % self.base
        self.inner = np.empty(len(triples), np.int64)  # bigram of words 2 and 3
        self.inner[of] = self.bi_of[at]

    def keys(self, bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each order: sorted keys of so many bits, the n-gram at each key, training counts in key order."""
        name = np.append(self.vocabulary, np.uint64(0x626567))
        two = join_hash(name[self.first], name[self.second])
        three = join_hash(two[self.context], name[self.third], np.zeros(len(self.third), np.uint64))
        out = []
        for key, of in ((self.vocabulary, self.ids), (two, self.bi_of), (three, self.tri_of)):
            used = self.train if of is not self.tri_of else self.train & self.has_tri
            key = key >> np.uint64(64 - bits)
            order = np.argsort(key)
            out.append((key[order], order, np.bincount(of[used], minlength=len(key))[order]))
        return out

    def context_counts(self, counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """c(h) of each bigram's and each trigram's context; begins are counted by ends."""
        end = np.searchsorted(self.vocabulary, _END)
        single = np.append(counts[0], counts[0][end] if self.V else 0)
        return single[self.first], counts[1][self.context]


def _bucket(count: np.ndarray) -> np.ndarray:
    """Half steps of log2; 0 for contexts never seen."""
    return np.where(count > 0, np.minimum(1 + np.floor(2 * np.log2(np.maximum(count, 1))), _BUCKETS - 1), 0).astype(np.uint8)


def _unseen(block: Block, counts: list[np.ndarray], local: list[np.ndarray]) -> np.ndarray:
    """[2, buckets, 2]: for bigrams and trigrams, by context bucket, the block's tokens and those of n-grams seen once.

    Buckets and "once" go by the corpus counts; what is added up are the
    block's own (``local``), so the sum over all blocks has every training
    token once, and an n-gram seen once in the block that holds it.
    """
    out = np.zeros((2, _BUCKETS, 2), np.int64)
    for k, (c, own, h) in enumerate(zip(counts[1:], local[1:], block.context_counts(counts))):
        at = _bucket(h)
        out[k, :, 0] = np.bincount(at, own, _BUCKETS)
        out[k, :, 1] = np.bincount(at, (c == 1) & (own == 1), _BUCKETS)
    return out


def _weights(stats: np.ndarray) -> np.ndarray:
    """Back-off weight by order and bucket: the share seen once, never rising with the context's count."""
    out = np.ones((2, _BUCKETS))
    for k in range(2):
        for b in range(1, _BUCKETS):
            tokens, once = stats[k, b]
            share = (once + 0.5) / (tokens + 1.0) if tokens else 1.0
            out[k, b] = min(out[k, b - 1], max(share, 1e-4), 0.999)
    return out


class Trie:
    """A slice of the model, built from seen n-grams and corpus counts."""

    def __init__(self, block: Block, counts: list[np.ndarray], tokens: int, kinds: int, weights: np.ndarray):
        V = block.V
        self.V, self.weights = V, weights
        self.vocabulary = EliasFano(EliasFano.build(block.vocabulary, 1 << 64)) if V else None
        self.base = np.log10((counts[0] + 0.5) / (tokens + 0.5 * (kinds + 1)))
        self.prob1 = self._code(self.base)
        single, double = block.context_counts(counts)

        seen = np.flatnonzero(counts[1] > 0)
        seen = seen[np.argsort(block.first[seen] * block.base + block.second[seen])]
        first, second = block.first[seen], block.second[seen]
        self.pairs = EliasFano(EliasFano.build(first * block.base + second, block.base * block.base))
        children = np.bincount(first, minlength=V + 1)
        self.pointer = EliasFano(EliasFano.build(np.concatenate([[0], np.cumsum(children)]), len(seen) + 1))
        self.back1 = np.append(_bucket(counts[0]), 0).astype(np.uint8)
        if V:
            self.back1[V] = _bucket(counts[0][np.searchsorted(block.vocabulary, _END)])
        b = weights[0][self.back1[first]]
        p = (1 - b) * counts[1][seen] / single[seen] + b * 10.0 ** self.value(self.prob1[second])
        self.prob2 = self._code(np.log10(p))
        self.back2 = _bucket(counts[1][seen])

        # level 3: where the context's last word has s successors, word 3 is one of s
        place = np.full(len(counts[1]), -1, np.int64)
        place[seen] = np.arange(len(seen))
        begin = np.concatenate([[0], np.cumsum(children)])
        span = children[second]
        offset = np.cumsum(span) - span
        self.before = EliasFano(EliasFano.build(offset, int(span.sum()) + 1))
        tri = np.flatnonzero(counts[2] > 0)
        context, inner = place[block.context[tri]], place[block.inner[tri]]
        code = offset[context] + inner - begin[first[inner]]
        order = np.argsort(code)
        self.triples = EliasFano(EliasFano.build(code[order], int(span.sum()) + 1))
        b = weights[1][self.back2[context]]
        p = (1 - b) * counts[2][tri] / double[tri] + b * 10.0 ** self.value(self.prob2[inner])
        self.prob3 = self._code(np.log10(p))[order]

    @staticmethod
    def _code(log10: np.ndarray) -> np.ndarray:
        return np.clip(np.rint(-log10 * _STEP), 0, 65535).astype(np.uint16)

    @staticmethod
    def value(code: np.ndarray) -> np.ndarray:
        return code / -_STEP

    def bigrams(self, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each bigram in level 2 (-1: unseen), and log10 p(second | first)."""
        at = self.pairs.find(first * (self.V + 1) + second)
        out = self.value(self.prob1[second]) + np.log10(self.weights[0])[self.back1[first]]
        seen = at >= 0
        out[seen] = self.value(self.prob2[at[seen]])
        return at, out

    def trigrams(self, context: np.ndarray, word: np.ndarray, inner: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """log10 p of trigrams: level-2 places of words 1-2 and of words 2-3, word 2, log10 p(word 3 | word 2).

        Word 3 is sought by its rank among word 2's successors.
        """
        out = lower.copy()
        known = np.flatnonzero(context >= 0)
        out[known] += np.log10(self.weights[1])[self.back2[context[known]]]
        known = known[inner[known] >= 0]
        if len(known):
            relative = inner[known] - self.pointer.access(word[known]).astype(np.int64)
            at = self.triples.find(self.before.access(context[known]).astype(np.int64) + relative)
            out[known[at >= 0]] = self.value(self.prob3[at[at >= 0]])
        return out


def key_bits(text_bytes: int) -> int:
    """Width of n-gram keys: at six bytes a word, under one expected pair of n-grams that meet by chance."""
    return min(64, max(32, 2 * text_bytes.bit_length() - 4))


def _ask(shards: int, bits: int):
    def ask(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        block = Block(B.documents(table))
        parts = block.keys(bits)
        cuts = [P.shard_cuts(key_, shards, bits) for key_, _, _ in parts]
        payloads = []
        for s in range(shards):
            body = []
            for (keys, _, count), cut in zip(parts, cuts):
                own = slice(cut[s], cut[s + 1])
                body += [P.pack_keys(keys[own]), P.pack(count[own])]
            payloads.append(P.joined(body))
        number = key[0].as_py()
        return pa.table({"shard": pa.array(range(shards), pa.int32()),
                         "block": pa.array([number] * shards, pa.int32()),
                         "payload": pa.array(payloads, pa.binary())})
    return ask


def _answer(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Corpus counts for every key asked, with this shard's tokens and distinct words."""
    table = table.sort_by("block")
    asked = [P.split(x) for x in table.column("payload").to_pylist()]
    bodies: list[list[bytes]] = [[] for _ in asked]
    tokens = kinds = 0
    for order in range(_ORDERS):
        keys = [P.unpack_keys(a[2 * order]) for a in asked]
        counts = [P.unpack(a[1 + 2 * order], np.int64) for a in asked]
        _, total, place = P.totals(keys, counts)
        if order == 0:
            tokens, kinds = int(total.sum()), int((total > 0).sum())
        at = 0
        for body, k in zip(bodies, keys):
            body.append(P.pack(total[place[at:at + len(k)]]))
            at += len(k)
    head = np.array([tokens, kinds], np.int64).tobytes()
    return pa.table({"shard": pa.array([key[0].as_py()] * len(asked), pa.int32()),
                     "block": table.column("block").cast(pa.int32()),
                     "payload": pa.array([P.joined([head, *b]) for b in bodies], pa.binary())})


def _counted(block: Block, got: list[list[bytes]], bits: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each order, corpus counts and the block's own training counts of its n-grams."""
    counts, local = [], []
    for order, (_, place, own) in enumerate(block.keys(bits)):
        for out, ranked in ((counts, np.concatenate([P.unpack(g[1 + order], np.int64) for g in got])), (local, own)):
            plain = np.empty(len(place), np.int64)
            plain[place] = ranked
            out.append(plain)
    return counts, local


def _bodies(answers: pa.Table) -> list[list[bytes]]:
    return [P.split(x) for x in answers.sort_by("shard").column("payload").to_pylist()]


def _tally(bits: int):
    def tally(key: tuple[pa.Scalar, ...], dealt: pa.Table, answers: pa.Table) -> pa.Table:
        docs = B.documents(dealt)
        cells = np.zeros((0, 2), np.int64)
        if docs.num_rows:
            block = Block(docs)
            cells = _unseen(block, *_counted(block, _bodies(answers), bits)).reshape(-1, 2)
        used = np.flatnonzero(cells[:, 0])
        return pa.table({"cell": pa.array(used, pa.int32()), "tokens": pa.array(cells[used, 0]),
                         "once": pa.array(cells[used, 1])})
    return tally


def _score(bits: int):
    def score(key: tuple[pa.Scalar, ...], dealt: pa.Table, answers: pa.Table) -> pa.Table:
        docs = B.documents(dealt)
        return _scored(docs, answers, bits) if docs.num_rows else _schema().empty_table()
    return score


def _scored(docs: pa.Table, answers: pa.Table, bits: int) -> pa.Table:
    got = _bodies(answers)
    heads = [np.frombuffer(g[0], np.int64) for g in got]
    tokens, kinds = int(sum(h[0] for h in heads)), int(sum(h[1] for h in heads))
    stats = np.zeros((2 * _BUCKETS, 2))
    for c in answers.column("cells").drop_null()[0].as_py():
        stats[c["cell"]] = c["tokens"], c["once"]
    weights = _weights(stats.reshape(2, _BUCKETS, 2))
    block = Block(docs)
    counts, _ = _counted(block, got, bits)
    trie = Trie(block, counts, tokens, kinds, weights)
    ids = np.append(trie.vocabulary.find(block.vocabulary), block.V)
    place, lower = trie.bigrams(ids[block.first], ids[block.second])
    upper = trie.trigrams(place[block.context], ids[block.second[block.context]], place[block.inner], lower[block.inner])
    each = np.where(block.has_tri, upper[block.tri_of] if len(upper) else 0.0, lower[block.bi_of])
    n = docs.num_rows
    return pa.table({
        "doc_id": docs.column("doc_id"), "held_out": docs.column("flag"),
        "n_tokens": pa.array(block.lengths.astype(np.int64)),
        "n_known": pa.array(np.bincount(block.doc, (counts[0] > 0)[block.ids], n).astype(np.int64)),
        "train_tokens": pa.array(np.full(n, tokens, np.int64)),
        "base_score": pa.array(np.bincount(block.doc, trie.base[block.ids], n)),
        "score": pa.array(np.bincount(block.doc, each, n))}).cast(_schema())


def _schema() -> pa.Schema:
    return pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                      ("n_known", pa.int64()), ("train_tokens", pa.int64()),
                      ("base_score", pa.float64()), ("score", pa.float64())])


def score_texts(df: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """Scores every row of df with the model learnt from its rows where held_out is false.

    held_out: boolean Column.  Result columns: doc_id, held_out, n_tokens,
    n_known, train_tokens, base_score, score; one row for each row of df.
    Null and empty texts hold the end token alone; a null held_out counts
    as false; rows with equal or null ids are scored each for itself; other
    columns are ignored.  An empty table gives an empty result.
    """
    total = B.text_bytes(df, text_col)
    blocks, bits = B.count_for(df, total, block_bytes), key_bits(total)
    docs = B.deal(df, blocks, id_col, text_col, held_out).repartition("block")
    asked = docs.groupBy("block").applyInArrow(_ask(blocks, bits), _PACKET)
    answers = asked.groupBy("shard").applyInArrow(_answer, _PACKET).repartition("block")
    tallies = docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_tally(bits), _TALLY)
    cells = tallies.groupBy("cell").agg(F.sum("tokens").alias("tokens"), F.sum("once").alias("once"))
    # one row of 96 cells at most; a block gets it with the answer of shard 0
    pooled = cells.agg(F.coalesce(F.min(F.lit(0)), F.lit(0)).alias("shard"),
                       F.collect_list(F.struct("cell", "tokens", "once")).alias("cells"))
    answers = answers.join(F.broadcast(pooled), "shard", "left")
    return docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score(bits), _SCORES)
