"""Language-model scores from a bigram trie that is cut into shards.

Tokens are words without white space, A-Z lower-cased, and one end after each text; the first token follows an end. With c for
counts in training texts, N for their tokens and V for the different ones, p(w) = (c(w) + 1) / (N + V + 1) and
p(w | h) = (c(h w) + M p(w)) / (c(h) + M): Dirichlet smoothing with M = `MASS`. Its logarithm is a sum of a part that the
pair (h, w) and the count of w give, and of -log10(c(w) + M) for each token w, which is the next token's context. So all that a
token needs is where its pairs are counted, and one shuffle is enough:

1. Words are counted (partial counts in tasks). That gives N, V, and the at most `HOT` words with N / HOT tokens or more.
2. Pairs of two such words are counted; there are at most HOT^2. The two small tables go to all tasks.
3. Each task packs its texts in chunks: for each shard the different pairs of a chunk, and the texts that hold them. Hot words and
   pairs of two are scored at once. A pair goes to the shard of its word, or, if only the word is hot, to that of its context.
   So a key has at most N / HOT tokens, however skewed the words are.
4. A shard builds its trie (Elias-Fano levels, mapped from a file; 16-bit quantised log10 values), looks up every pair in it
   and returns, for each chunk, the sums of its texts; a chunk's sums are added up.

Null texts are empty: one end. Ids may be null or repeated; every row is scored by itself. An empty table gives no rows; with
nothing to learn from all probabilities are 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrace.llm.elias_fano import NgramTrie
from runtrace.llm.textbytes import UNSPACED, mix, slices
from runtrace.sources.staging import stage

MASS = 64.0
HOT = 512
#: Tokens of a chunk and of a shard, about.
CHUNK_TOKENS = 1_000_000
SHARD_TOKENS = 1_250_000
#: Texts of a chunk at most; their numbers and a bit for training have 16 bits.
CHUNK_TEXTS = 30_000
END = np.uint64(0x5E9D_0F00_0E9D_1234)


def _tokens(part) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token, its context, and its text."""
    starts, ends = part.runs(UNSPACED)
    owners = part.texts_of(starts)
    stops = np.cumsum(part.per_text(owners)) + np.arange(part.n)
    tokens, texts = np.full(len(starts) + part.n, END), np.repeat(np.arange(part.n), np.diff(stops, prepend=-1))
    tokens[np.arange(len(starts)) + owners] = part.hashes(starts, ends)
    return tokens, np.concatenate([[END], tokens[:-1]]), texts


def _learns(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column(1).fill_null(False).to_numpy(zero_copy_only=False), bool)


def _sum_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    keys, inverse = np.unique(keys, return_inverse=True)
    return keys, np.bincount(inverse, counts, minlength=len(keys)).astype(np.int64)


def _place(table: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of keys in a rising table, and whether they are in it."""
    if len(table) == 0:
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    place = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    return place, table[place] == keys


class LanguageModel:
    """What all tasks know: totals, and the counts of hot words and of pairs of them."""

    def __init__(self, n: int, v: int, total: int, hot: list[tuple[int, int]], pairs: dict[int, int] | None = None):
        self.n, self.v, self.shards, self.chunk_tokens = n, v, max(1, -(-total // SHARD_TOKENS)), CHUNK_TOKENS
        order = sorted((h & (2**64 - 1), c) for h, c in hot)
        self.hot = np.array([h for h, _ in order], np.uint64)
        self.hot_counts = np.array([c for _, c in order], np.int64)
        self.pairs = np.zeros((len(order), len(order)), np.int64)  # context, word
        for key, c in (pairs or {}).items():
            self.pairs.flat[key] = c

    def mass(self, count: np.ndarray) -> np.ndarray:
        """M p(w) from c(w)."""
        return MASS * (count + 1) / (self.n + self.v + 1)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((count + 1) / (self.n + self.v + 1))

    @staticmethod
    def as_context(count: np.ndarray) -> np.ndarray:
        return -np.log10(count + MASS)

    def shard_of(self, keys: np.ndarray) -> np.ndarray:
        return ((mix(keys) >> np.uint64(32)) * np.uint64(self.shards) >> np.uint64(32)).astype(np.int32)


def count(texts: DataFrame) -> LanguageModel:
    """Totals and hot words of texts (text, learn)."""
    spark = texts.sparkSession

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, n, all_tokens = [], 0, 0

        def rows(hashes, counts):
            return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], names=["word", "n"])

        for batch, part in slices(batches, "text"):
            tokens, _, owner = _tokens(part)
            all_tokens += len(tokens)
            kept.append(np.unique(tokens[_learns(batch)[owner]], return_counts=True))
            n += len(kept[-1][0])
            if n > 2_000_000:
                kept, n = [_sum_by(*map(np.concatenate, zip(*kept)))], 0
                if len(kept[0][0]) > 1_000_000:
                    yield rows(*kept.pop())
        if kept:
            yield rows(*_sum_by(*map(np.concatenate, zip(*kept))))
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([all_tokens], pa.int64())], names=["word", "n"])

    counted = stage(texts.select("text", "learn").mapInArrow(words, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "lm-words")
    known = counted.where("word IS NOT NULL")
    totals = known.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    total = counted.where("word IS NULL").agg(F.sum("n")).first()[0] or 0
    hot = [tuple(r) for r in known.where(F.col("n") >= max(1.0, totals.n / HOT)).collect()] if totals.n >= HOT else []
    model = LanguageModel(totals.n, totals.v, total, hot)
    shared = spark.sparkContext.broadcast(model)

    def pairs(batches):
        model = shared.value
        found = np.zeros(model.pairs.size, np.int64)
        for batch, part in slices(batches, "text"):
            tokens, context, owner = _tokens(part)
            w, hot_w = _place(model.hot, tokens)
            h, hot_h = _place(model.hot, context)
            both = hot_w & hot_h & _learns(batch)[owner]
            found += np.bincount(h[both] * len(model.hot) + w[both], minlength=len(found))
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(found[at])], names=["pair", "n"])

    if hot:
        rows = texts.select("text", "learn").mapInArrow(pairs, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        model = LanguageModel(totals.n, totals.v, total, hot, {r.pair: r.n for r in rows.collect()})
    return model


_REQUEST = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("first_row", pa.int64()), *[
    (c, pa.binary()) for c in ("nodes", "fan", "children", "spread", "who")]])
_REQUEST_DDL = "shard int, kind int, first_row bigint, nodes binary, fan binary, children binary, spread binary, who binary"
#: Kinds of requests: contexts under a word; hot words under a context; sums that are done.
_UNDER_WORD, _UNDER_CONTEXT, _DONE = 0, 1, 2


def _pack(shard: np.ndarray, node: np.ndarray, child: np.ndarray, who: np.ndarray, kind: int, first_row: int) -> Iterator[dict]:
    """A request for each shard: different nodes, children under each, and the texts of each pair, once for each token."""
    order = np.lexsort((who, child, node, shard))
    shard, node, child, who = shard[order], node[order], child[order], who[order]
    if not len(shard):
        return
    new_shard = np.concatenate([[True], shard[1:] != shard[:-1]])
    new_node = new_shard | np.concatenate([[True], node[1:] != node[:-1]])
    new_pair = new_node | np.concatenate([[True], child[1:] != child[:-1]])
    bounds = np.append(np.flatnonzero(new_shard), len(shard))
    for a, b in zip(bounds[:-1], bounds[1:]):
        pairs = np.flatnonzero(new_pair[a:b])
        nodes = np.flatnonzero(new_node[a:b])
        fan = np.diff(np.append(np.searchsorted(pairs, nodes), len(pairs)))
        yield {"shard": int(shard[a]), "kind": kind, "first_row": first_row, "nodes": node[a:b][nodes].tobytes(),
               "fan": fan.astype(np.uint32).tobytes(), "children": child[a:b][pairs].tobytes(),
               "spread": np.diff(np.append(pairs, b - a)).astype(np.uint32).tobytes(), "who": who[a:b].tobytes()}


#: Sums of one chunk from one shard: texts by their number, and what they add up to. Ids and tokens come with what is done.
_PARTS = ("who", "known", "base", "score", "ids", "valid", "tokens")
_PARTS_DDL = "first_row bigint, " + ", ".join(f"{c} binary" for c in _PARTS)
_SUMS_DDL = "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double"


def _part(first_row: int, who: np.ndarray, known, base, score, ids=b"", valid=b"", tokens=b"") -> dict:
    arrays = (who.astype(np.uint16), known.astype(np.int32), base.astype(np.float64), score.astype(np.float64))
    return {"first_row": first_row, **dict(zip(_PARTS, (*[x.tobytes() for x in arrays], ids, valid, tokens)))}


class _Chunk:
    """Texts of one task that are packed together."""

    def __init__(self, first_row: int):
        self.first_row, self.parts, self.ids, self.learn, self.texts, self.tokens = first_row, [], [], [], 0, 0

    def add(self, batch: pa.RecordBatch, part) -> None:
        tokens, context, owner = _tokens(part)
        self.parts.append((tokens, context, owner + self.texts))
        self.ids.append(batch.column(2))
        self.learn.append(_learns(batch))
        self.texts += part.n
        self.tokens += len(tokens)

    def requests(self, model: LanguageModel) -> Iterator[dict]:
        token, context, owner = map(np.concatenate, zip(*self.parts))
        who = (owner * 2 + np.concatenate(self.learn)[owner]).astype(np.uint16)
        w, hot_w = _place(model.hot, token)
        h, hot_h = _place(model.hot, context)
        known, base, score = (np.zeros(len(token)) for _ in range(3))
        counts = model.hot_counts[w[hot_w]]
        known[hot_w], base[hot_w], score[hot_w] = counts > 0, model.base(counts), model.as_context(counts)
        both = hot_w & hot_h
        score[both] += np.log10(model.pairs[h[both], w[both]] + model.mass(model.hot_counts[w[both]]))
        done = [np.bincount(owner, x, minlength=self.texts) for x in (None, known, base, score)]
        ids = pa.concat_arrays(self.ids)
        yield {"shard": self.first_row % model.shards, "kind": _DONE, "first_row": self.first_row,
               "nodes": np.asarray(ids.fill_null(0), np.int64).tobytes(), "fan": np.asarray(ids.is_valid(), bool).tobytes(),
               "children": done[0].astype(np.int64).tobytes(), "spread": done[1].astype(np.int64).tobytes(),
               "who": np.concatenate(done[2:]).tobytes()}
        plain = ~hot_w
        yield from _pack(model.shard_of(token[plain]), token[plain], context[plain], who[plain], _UNDER_WORD, self.first_row)
        mixed = hot_w & ~hot_h
        yield from _pack(model.shard_of(context[mixed]), context[mixed], token[mixed], who[mixed], _UNDER_CONTEXT, self.first_row)


def _bounded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most `CHUNK_TEXTS`."""
    for batch in batches:
        for first in range(0, batch.num_rows, CHUNK_TEXTS):
            yield batch.slice(first, CHUNK_TEXTS)


def _requests(texts: DataFrame, model: LanguageModel) -> DataFrame:
    shared = texts.sparkSession.sparkContext.broadcast(model)

    def work(batches):
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        chunk = _Chunk(first)
        for batch, part in slices(_bounded(batches), "text"):
            if chunk.tokens >= shared.value.chunk_tokens or chunk.texts + part.n > CHUNK_TEXTS:
                if chunk.texts:
                    yield from _batches(chunk.requests(shared.value))
                chunk = _Chunk(chunk.first_row + chunk.texts)
            chunk.add(batch, part)
        if chunk.texts:
            yield from _batches(chunk.requests(shared.value))

    def _batches(rows):
        for row in rows:
            yield pa.RecordBatch.from_pylist([row], schema=_REQUEST)

    return texts.select("text", "learn", "doc_id").mapInArrow(work, _REQUEST_DDL)


def _answer(table: pa.Table, model: LanguageModel) -> pa.Table:
    """Sums for the texts of each chunk, from all requests of one shard."""
    rows, out = table.to_pylist(), []
    del table
    for r in rows:
        if r["kind"] == _DONE:
            base, score = np.frombuffer(r["who"]).reshape(2, -1)
            out.append(_part(r["first_row"], np.arange(len(base)), np.frombuffer(r["spread"], np.int64), base, score,
                             r["nodes"], r["fan"], r["children"]))
    by_kind = {kind: [r for r in rows if r["kind"] == kind] for kind in (_UNDER_WORD, _UNDER_CONTEXT)}
    rows.clear()
    for kind, some in by_kind.items():
        if some:
            out += _answer_kind(some, kind, model)
    return pa.Table.from_pylist(out, schema=pa.schema([("first_row", pa.int64()), *[(c, pa.binary()) for c in _PARTS]]))


def _add_up(table: pa.Table) -> pa.Table:
    """The texts of one chunk from the sums of all shards; at most one number for each token."""
    rows = table.to_pylist()
    done = next(r for r in rows if r["tokens"])
    tokens = np.frombuffer(done["tokens"], np.int64)
    ids = pa.array(np.frombuffer(done["ids"], np.int64), mask=~np.frombuffer(done["valid"], bool))
    who = np.concatenate([np.frombuffer(r["who"], np.uint16) for r in rows])
    known, base, score = (
        np.bincount(who, np.concatenate([np.frombuffer(r[c], kind) for r in rows]), minlength=len(tokens))
        for c, kind in (("known", np.int32), ("base", np.float64), ("score", np.float64)))
    return pa.table([ids, pa.array(tokens), pa.array(np.round(known).astype(np.int64)), pa.array(base), pa.array(score)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])


def _answer_kind(rows: list[dict], kind: int, model: LanguageModel) -> list[dict]:
    def column(name, dtype):
        return np.concatenate([np.frombuffer(r[name], dtype) for r in rows])

    children, spread, who = column("children", np.uint64), column("spread", np.uint32).astype(np.int64), column("who", np.uint16)
    node = np.repeat(column("nodes", np.uint64), column("fan", np.uint32))
    chunks, sizes = [r["first_row"] for r in rows], [len(r["who"]) // 2 for r in rows]
    rows.clear()  # the blobs are as large as what was made of them
    learned = np.add.reduceat((who & 1).astype(np.int64), np.cumsum(spread) - spread)

    order = np.lexsort((children, node))
    s_node, s_child = node[order], children[order]
    new = np.concatenate([[True], (s_node[1:] != s_node[:-1]) | (s_child[1:] != s_child[:-1])])
    firsts = np.flatnonzero(new)
    pair_counts = np.add.reduceat(learned[order], firsts)
    seen = firsts[pair_counts > 0]
    pair_node, pair_child, pair_counts = s_node[seen], s_child[seen], pair_counts[pair_counts > 0]
    nodes, pair_place = np.unique(pair_node, return_inverse=True)
    counts = np.bincount(pair_place, pair_counts, minlength=len(nodes)).astype(np.int64)
    word_count = counts[pair_place] if kind == _UNDER_WORD else model.hot_counts[_place(model.hot, pair_child)[0]]
    values = np.log10(pair_counts + model.mass(word_count))
    trie = NgramTrie.build(nodes, counts, np.log10(model.mass(counts)), pair_place, pair_child, values).mapped()

    there, value = trie.child(node, children)
    known, base = np.zeros(len(node)), np.zeros(len(node))
    if kind == _UNDER_WORD:
        asked, inverse = np.unique(node, return_inverse=True)
        has, count_, unseen = trie.node(asked)
        unseen = np.where(has, unseen, np.log10(model.mass(0)))
        value = np.where(there, value, unseen[inverse]) + model.as_context(count_)[inverse]
        known, base = (count_ > 0)[inverse].astype(float), model.base(count_)[inverse]
    else:
        value = np.where(there, value, np.log10(model.mass(model.hot_counts[_place(model.hot, children)[0]])))
    bounds, out = np.concatenate([[0], np.cumsum(sizes)]), []
    known, base, value = (np.repeat(x, spread) for x in (known, base, value))
    for first_row, a, b in zip(chunks, bounds[:-1], bounds[1:]):
        there, inverse = np.unique(who[a:b] >> 1, return_inverse=True)
        out.append(_part(first_row, there, *[np.bincount(inverse, x[a:b], minlength=len(there)) for x in (known, base, value)]))
    return out


def score(docs: DataFrame, learnable, text: str = "text") -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, n_known, train_tokens, base_score, score; learns from learnable rows."""
    texts = docs.select(docs[text].alias("text"), learnable.alias("learn"), docs["doc_id"].cast("bigint").alias("doc_id"))
    model = count(texts)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def answer(table: pa.Table) -> pa.Table:
        return _answer(table, shared.value)

    parts = _requests(texts, model).groupBy("shard").applyInArrow(answer, _PARTS_DDL)
    sums = parts.groupBy("first_row").applyInArrow(_add_up, _SUMS_DDL)
    return sums.select("doc_id", "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score", "score")
