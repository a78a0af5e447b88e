"""N-gram Jaccard join: documents whose word shingles overlap, found with prefix trees.

A document's set holds its distinct runs of five words (white-space separated, A-Z lower-cased); with fewer words, the whole
text as one run. Two documents link if 100 * intersection >= 80 * union. The result gives each document its set size and
the smallest id that it reaches by links. Null texts and texts without words have empty sets and link with nothing.

All sets are ordered by one global order: rare shingles by hash, then frequent ones by rising count. Any order gives the same
links; this one keeps shared passages out of the prefixes. Of a set of n, the first n - ceil(0.8 n) + 1 shingles are its
prefix, and sets that link share one in both prefixes.

1. Frequent shingles: those in two or more documents, counted over all documents; the most frequent, up to `FREQUENT`, go to all tasks.
   A histogram of their counts gives the least count that is taken. The others have their place in the order by hash.
2. Prefixes of all documents; equal sets become one class (grouped by set signature, so copies are never paired).
3. Postings are rows of a shingle, a class and a place. Shingles are counted by partial sums and joined back, so only what two or
   more classes share goes on, and no list of a shingle is ever gathered.
4. Star rounds: each shingle has a centre, the least of its classes by rank (first the class that meets most others, then the one with
   most links), found by partial minima and joined back. Each class is compared with the `CENTRES` centres of other components
   it shares most prefix shingles with: so many comparisons for a class and round, however many near copies there are.
5. Last round: only classes meet whose shingle still has different components, and only where it comes so
   early in both sets that it can be their first common one. A list longer than `BLOCK` is cut into blocks, and each two of them
   are compared by themselves. Pairs whose shared prefix shingles can't reach the overlap any
   more are dropped, the rest compared. So no link between components is lost.
6. Components of the links, by alternating large and small stars over stored tables.
7. Links of each document. All links of a class lie in its component, so the sets of a component are compared with each other, and
   also pairs that steps 4 and 5 skip since they carry one label already are verified and counted. The classes of a component
   are dealt into blocks of about `BLOCK_SHINGLES` shingles, and each two blocks are compared by themselves; only sums by class leave a task, never
   the pairs. A component of two classes has one link. Links with copies count each copy.

A comparison builds a prefix tree of the ordered sets that are compared with one set (at most `GROUP`, larger groups are salted),
and walks it once: sets that begin alike share the counting, and a subtree is left as soon as the overlap so far and the shingles that
remain, in the tree or in the set, can't reach what the smallest set below would need. In step 7 all sets of the other block walk one tree together.

Ids may be null or repeated: equal sets are one class, a component's id is its smallest id that is not null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from runtrace.llm.rows import FEW_KEYS, same_text, without
from runtrace.llm.textbytes import UNSPACED, Slice, chain, mix, slices, windows
from runtrace.sources.staging import settle, short_shuffles, small_batches, stage

SHINGLE = 5
FREQUENT = 1 << 20
#: Members that one set is compared with at once, and rows of a task of comparisons.
GROUP = 256
COMPARED_AT_ONCE = 2000
#: Classes of one list that are compared pair by pair in one task, and rows of such a task.
BLOCK = 4096
POSTINGS_AT_ONCE = 200_000
#: Shingles of a block of sets that are compared with each other, and shingles of such a task.
BLOCK_SHINGLES = 500_000
DENSE_AT_ONCE = 2_000_000
#: Star rounds end when one links less than a fifth of the classes that meet, or after so many.
STAR_ROUNDS = 6
CENTRES = 2
#: Bytes of text whose shingles a task holds at once, and shingles of a batch that leaves it to be counted.
_BYTES = 250_000
_COUNTED = 250_000
#: Bytes of text for each range of hashes that is counted at once.
_RANGE = 8_000_000
_RARE = np.uint64(2**63 - 1)
_FREQUENT = np.uint64(2**63)


def prefix_length(n):
    return n - (4 * n + 4) // 5 + 1


def needed(n, m):
    """The least intersection of linked sets of n and m."""
    return -(-4 * (n + m) // 9)


def shingles(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the texts they are of, repeats included."""
    starts, ends = part.runs(UNSPACED)
    hashes, owners = part.hashes(starts, ends), part.texts_of(starts)
    many, of, _ = windows(hashes, owners, SHINGLE)
    words = part.per_text(owners)
    first = np.concatenate([[0], np.cumsum(words)])
    few, texts = [], []
    for n in range(1, SHINGLE):
        short = np.flatnonzero(words == n)
        if len(short):
            few.append(chain([hashes[first[short] + k] for k in range(n)]))
            texts.append(short)
    return np.concatenate([many, *few]), np.concatenate([of, *texts]).astype(np.int64)


def _ordered(part: Slice, frequent: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sets of a slice in the global order: shingle keys and where each text's begin."""
    hashes, owners = shingles(part)
    keys = hashes & _RARE
    if len(frequent):
        place = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        often = frequent[place] == hashes
        keys[often] = _FREQUENT | ranks[place[often]].astype(np.uint64)
    order = np.lexsort((keys, owners))
    keys, owners = keys[order], owners[order]
    new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])]) if len(keys) else np.zeros(0, bool)
    keys, owners = keys[new], owners[new]
    return keys, np.searchsorted(owners, np.arange(part.n + 1))


def _ranges(hashes: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """(range, hashes, counts): different hashes with how often each was there, cut where ranges of hashes start."""
    values, counts = np.unique(hashes, return_counts=True)
    counts = counts.astype(np.uint32)
    bounds = np.append(np.searchsorted(values, starts), len(values))
    filled = np.flatnonzero(np.diff(bounds))
    pieces = list(zip(bounds[filled].tolist(), bounds[filled + 1].tolist()))
    return pa.RecordBatch.from_arrays(
        [pa.array(filled.astype(np.int32)), *[pa.array([x[a:b].tobytes() for a, b in pieces], pa.binary()) for x in (values, counts)]],
        names=["range", "hashes", "counts"])


def _repeated(table: pa.Table) -> pa.Table:
    """(shingle, n): the hashes of a range that came more than once, with their sums."""
    hashes, counts = (np.frombuffer(b"".join(table.column(c).to_pylist()), kind) for c, kind in (("hashes", np.uint64), ("counts", np.uint32)))
    order = np.argsort(hashes, kind="stable")
    hashes, counts = hashes[order], counts[order].astype(np.int64)
    firsts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    n = np.add.reduceat(counts, firsts)
    return pa.table([pa.array(hashes[firsts][n > 1].view(np.int64)), pa.array(n[n > 1])], names=["shingle", "n"])


def frequent_shingles(docs: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of shingles that many documents share, rising, and the rank of each by count.

    All shingles of all documents are counted, range by range of their hashes: tasks send sorted pieces of each range with
    partial counts, so a shingle that every text has stays small. `limit` bounds what goes to all tasks: it only decides how many pairs meet, not which of
    them link.
    """

    spark, text = docs.sparkSession, docs.select("text")
    size = text.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(1, (size // _RANGE).bit_length())
    starts = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, size = [], 0
        for _, part in slices(batches, "text", size=_BYTES):
            hashes, owners = shingles(part)
            order = np.lexsort((hashes, owners))
            hashes, owners = hashes[order], owners[order]
            kept.append(hashes[np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])])] if len(hashes) else hashes)
            size += len(kept[-1])
            if size > _COUNTED:
                yield _ranges(np.concatenate(kept), starts)
                kept, size = [], 0
        if size:
            yield _ranges(np.concatenate(kept), starts)

    with short_shuffles(spark):
        ranges = text.mapInArrow(work, "range int, hashes binary, counts binary")
        counts = ranges.groupBy("range").applyInArrow(_repeated, "shingle bigint, n bigint")
        counts = stage(counts.withColumn("level", F.floor(16 * F.log2("n")).cast("int")), "jaccard-counts")
    least, taken = 0, 0
    for level, n in sorted(counts.groupBy("level").count().collect(), reverse=True):  # at most 16 for each power of two
        taken += n
        if taken > limit:
            least = level + 1
            break
    rows = counts.where(F.col("level") >= least).select("shingle", "n").toArrow().sort_by([("n", "descending"), ("shingle", "ascending")])
    hashes = np.asarray(rows.column(0).to_numpy()).astype(np.int64).view(np.uint64)
    ranks = np.arange(len(hashes), 0, -1).astype(np.uint32)  # the most frequent comes last
    order = np.argsort(hashes)
    return hashes[order], ranks[order]


def _set_rows(docs: DataFrame, order, whole: bool, keys: list[str]) -> DataFrame:
    """Keys of rows, set size, signature, and the set or its prefix."""

    def work(batches):
        frequent, ranks = order.value
        for batch, part in slices(batches, "text", size=_BYTES):
            tokens, bounds = _ordered(part, frequent, ranks)
            size = np.diff(bounds)
            signatures = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(tokens + np.uint64(salt)))]) for salt in (0x1234567, 0xABCDEF9)]
            both = np.stack([s[bounds[1:]] - s[bounds[:-1]] for s in signatures], axis=1)
            length = size if whole else np.where(size > 0, prefix_length(size), 0)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i) for i in range(len(keys))], pa.array(size, pa.int64()), pa.array([s.tobytes() for s in both], pa.binary()),
                 pa.array([tokens[a:a + n].tobytes() for a, n in zip(bounds[:-1].tolist(), length.tolist())], pa.binary())],
                names=[*keys, "n", "signature", "tokens"])

    kinds = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys]
    return docs.select(*keys, "text").mapInArrow(work, ", ".join([*kinds, "n bigint, signature binary, tokens binary"]))


def _postings(classes: DataFrame) -> DataFrame:
    """(cls, n, place, shingle): a row for each shingle of the prefixes of classes (cls, n, tokens)."""

    def work(batches):
        for batch in batches:
            tokens = batch.column("tokens").to_pylist()
            lengths = np.array([len(t) // 8 for t in tokens], np.int64)
            flat = np.frombuffer(b"".join(tokens), np.int64)
            place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            repeated = [np.repeat(np.asarray(batch.column(c)), lengths) for c in ("cls", "n")]
            for at in range(0, len(flat), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 100_000]) for x in (*repeated, place.astype(np.int32), flat)],
                                                 names=["cls", "n", "place", "shingle"])

    return classes.select("cls", "n", "tokens").mapInArrow(work, "cls bigint, n bigint, place int, shingle bigint")


def _counted(a: np.ndarray, b: np.ndarray) -> pa.Table:
    """Different pairs with how often each was there."""
    if len(a) == 0:
        return pa.table([pa.array([], pa.int64())] * 3, names=["a", "b", "shared"])
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    firsts = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    return pa.table([pa.array(a[firsts]), pa.array(b[firsts]), pa.array(np.diff(np.append(firsts, len(a))))], names=["a", "b", "shared"])


def _stars(rows: DataFrame) -> DataFrame:
    """(a, b, shared): classes with the centres of their shingles, where they are of other components, and how often they meet."""
    lists = rows.groupBy("shingle").agg(F.min(F.struct("rank", "cls", "label")).alias("centre"), F.min("label").alias("low"), F.max("label").alias("high"))
    met = rows.join(lists.where("low <> high").select("shingle", "centre"), "shingle").where(F.col("label") != F.col("centre.label"))
    return met.groupBy(F.col("centre.cls").alias("a"), F.col("cls").alias("b")).agg(F.count("*").alias("shared"))


def _mixed(rows: DataFrame) -> DataFrame:
    """(bucket, list, cls, n, place, label): lists with several components, those over BLOCK as pairs of blocks."""
    lists = rows.groupBy("shingle").agg(F.count("*").alias("members"), F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high")
    own = rows.join(lists.select("shingle", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), "shingle")
    own = own.withColumn("block", F.pmod(F.xxhash64(F.lit(3), "cls"), F.col("blocks")).cast("int"))
    own = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    own = own.withColumn("list", F.xxhash64("shingle", F.least("block", "other"), F.greatest("block", "other")))
    own = stage(own.select("list", "cls", "n", "place", "label"), "jaccard-mixed")
    tasks = max(1, -(-own.count() // POSTINGS_AT_ONCE))
    return own.withColumn("bucket", F.pmod(F.xxhash64("list"), F.lit(tasks)).cast("int"))


def _crossings(table: pa.Table) -> pa.Table:
    """Pairs of classes of different components that may link: their first common shingle has to come early in both sets."""
    lists, cls, size, label, place = (table.column(c).to_numpy() for c in ("list", "cls", "n", "label", "place"))
    number = np.unique(lists, return_inverse=True)[1]
    order = np.lexsort((size, number))
    number, cls, size, label, place = number[order], cls[order], size[order], label[order], place[order]
    found: list[pa.Table] = []
    low = np.arange(len(number))
    step = 1
    while len(low):
        low = low[low + step < len(number)]
        high = low + step
        near = (number[low] == number[high]) & (5 * size[low] >= 4 * size[high])
        low, high = low[near], high[near]  # sizes rise, so no later one fits either
        least = needed(size[low], size[high])
        early = (place[low] <= size[low] - least) & (place[high] <= size[high] - least)
        cross = early & (label[low] != label[high])
        a, b = cls[low[cross]], cls[high[cross]]
        if len(a):
            found.append(_counted(np.minimum(a, b), np.maximum(a, b)))
        if len(found) > 64:
            found = [_merged(found)]
        step += 1
    return _merged(found) if found else _counted(number[:0], cls[:0])


def _merged(found: list[pa.Table]) -> pa.Table:
    t = pa.concat_tables(found).group_by(["a", "b"]).aggregate([("shared", "sum")])
    return pa.table([t.column("a"), t.column("b"), t.column("shared_sum")], names=["a", "b", "shared"])


class PrefixTree:
    """Ordered sets; an edge holds the shingles that all sets below share, and the sizes of the sets below."""

    __slots__ = ("edges", "ends")

    def __init__(self):
        self.edges: dict[int, list] = {}  # first shingle: [shingles, subtree, smallest size, largest size]
        self.ends: list[tuple[int, int]] = []

    def add(self, tokens: np.ndarray, member: int) -> None:
        node, size = self, len(tokens)
        while len(tokens):
            edge = node.edges.get(int(tokens[0]))
            if edge is None:
                leaf = PrefixTree()
                node.edges[int(tokens[0])] = [tokens, leaf, size, size]
                node = leaf
                break
            n = min(len(edge[0]), len(tokens))
            differ = np.flatnonzero(edge[0][:n] != tokens[:n])
            same = int(differ[0]) if len(differ) else n
            if same < len(edge[0]):
                middle = PrefixTree()
                middle.edges[int(edge[0][same])] = [edge[0][same:], *edge[1:]]
                edge[0], edge[1] = edge[0][:same], middle
            edge[2], edge[3] = min(edge[2], size), max(edge[3], size)
            node, tokens = edge[1], tokens[same:]
        node.ends.append((member, size))

    def linked(self, tokens: np.ndarray, at_once: int = 128) -> list[int]:
        """Members that link with a set."""
        found, size = [], len(tokens)
        stack = [(self, 0, 0)]
        while stack:
            node, overlap, depth = stack.pop()
            found += [member for member, n in node.ends if overlap >= needed(size, n)]
            for part, below, smallest, largest in node.edges.values():
                least, here, at = needed(size, smallest), overlap, 0
                while at < len(part):
                    some = part[at:at + at_once]
                    place = np.searchsorted(tokens, some)
                    here += int((tokens[np.minimum(place, size - 1)] == some).sum())
                    at += len(some)
                    if here + min(size - int(place[-1]), largest - depth - at) < least:
                        break
                else:
                    stack.append((below, here, depth + len(part)))
        return found


    def linked_with(self, sets: list[np.ndarray], at_once: int = 128) -> Iterator[tuple[int, np.ndarray]]:
        """Members with the places of the sets they link with; all sets walk the tree together."""
        sizes = np.array([len(s) for s in sets], np.int64)
        tokens, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(tokens, kind="stable")
        owners = owners[order]
        known, firsts = np.unique(tokens[order], return_index=True)
        ends = np.append(firsts[1:], len(tokens))
        # Overlaps of a subtree are computed when its turn comes, so only those of its ancestors are held.
        stack = [([(np.zeros(0, np.uint64), self, 1, 1 << 60)], np.zeros(len(sets), np.int64), 0, np.ones(len(sets), bool))]
        while stack:
            edges, overlap, depth, alive = stack[-1]
            if not edges:
                stack.pop()
                continue
            part, below, smallest, largest = edges.pop()
            least, here, at = needed(sizes, smallest), overlap, 0
            while at < len(part) and alive.any():
                some = part[at:at + at_once]
                place = np.minimum(np.searchsorted(known, some), len(known) - 1)
                place = place[known[place] == some]
                counts = ends[place] - firsts[place]
                holders = np.repeat(firsts[place] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
                here = here + np.bincount(owners[holders], minlength=len(sets))
                at += len(some)
                alive = alive & (here + np.minimum(sizes - here, largest - depth - at) >= least)
            if not alive.any():
                continue
            for member, n in below.ends:
                linked = np.flatnonzero(alive & (here >= needed(sizes, n)))
                if len(linked):
                    yield member, linked
            stack.append(([tuple(e) for e in below.edges.values()], here, depth + len(part), alive))


def _link_sums(table: pa.Table) -> pa.Table:
    """(cls, links): for the sets of pairs of blocks (label, low, high), the rows of the classes that each links with there."""
    label, low, high, block, cls, rows = (table.column(c).to_numpy() for c in ("label", "low", "high", "block", "cls", "rows"))
    tokens = table.column("tokens").to_pylist()
    order = np.lexsort((high, low, label))
    new = (label[order][1:] != label[order][:-1]) | (low[order][1:] != low[order][:-1]) | (high[order][1:] != high[order][:-1])
    links = np.zeros(len(order), np.int64)
    for group in np.split(order, np.flatnonzero(new) + 1) if len(order) else ():
        first = low[group[0]]
        inside = first == high[group[0]]
        left = group[block[group] == first]
        tree = PrefixTree()
        for r in (left if inside else group[block[group] != first]).tolist():
            tree.add(np.frombuffer(tokens[r], np.uint64), r)
        if not (len(left) and (tree.edges or tree.ends)):
            continue
        for member, linked in tree.linked_with([np.frombuffer(tokens[r], np.uint64) for r in left.tolist()]):
            links[left[linked]] += rows[member]
            if not inside:
                links[member] += rows[left[linked]].sum()
        if inside:
            links[left] -= rows[left]  # each set meets itself once
    return pa.table([pa.array(cls), pa.array(links)], names=["cls", "links"])


def _compare(table: pa.Table) -> pa.Table:
    """Links between centres and their members, one tree for each centre."""
    groups: dict[tuple, list] = {}
    centres = {}
    for r in table.to_pylist():
        tokens = np.frombuffer(r["tokens"], np.uint64)
        if r["b"] is None:
            centres[r["a"]] = tokens
        else:
            groups.setdefault(r["a"], []).append((r["b"], tokens))
    links = []
    for a, members in groups.items():
        tree = PrefixTree()
        for b, tokens in members:
            tree.add(tokens, b)
        links += [(a, b) for b in tree.linked(centres[a])]
    return pa.table([pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())], names=["a", "b"])


def _whole_sets(ids: DataFrame, docs: DataFrame, classes: DataFrame, order) -> DataFrame:
    """(cls, tokens): the whole sets of different classes (cls). Texts are read again."""
    wanted = stage(classes.join(ids, "cls").select("cls", "member.*"), "jaccard-wanted")
    wanted = wanted.select("cls", F.col("doc_id").alias("w_id"), F.col("text_hash").alias("w_hash"))
    few = _few(wanted)
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    texts = texts.join(few, texts["doc_id"].eqNullSafe(few["w_id"]) & (texts["text_hash"] == few["w_hash"])).select("cls", "text")
    sets = stage(_set_rows(texts, order, True, ["cls"]).select("cls", "tokens"), "jaccard-sets")
    if sets.count() > wanted.count():  # rows with equal ids and texts
        sets = stage(sets.dropDuplicates(["cls"]), "jaccard-sets")
    return sets


def _link_counts(docs: DataFrame, classes: DataFrame, labels: DataFrame, order) -> DataFrame:
    """(cls, links): how many rows of other classes those of a class link with, for the classes in labels."""
    members = stage(classes.select("cls", "n", "rows").join(labels, "cls"), "jaccard-members")
    sizes = members.groupBy("label").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"), F.sum("rows").alias("all_rows"))
    members = members.join(sizes, "label")
    two = members.where("classes = 2").select("cls", (F.col("all_rows") - F.col("rows")).alias("links"))
    dense = members.where("classes > 2").withColumn("blocks", F.ceil(F.col("shingles") / BLOCK_SHINGLES).cast("int"))
    dense = dense.withColumn("block", F.pmod(F.xxhash64(F.lit(5), "cls"), F.col("blocks")).cast("int"))
    dense = stage(dense.select("cls", "n", "rows", "label", "block", "blocks"), "jaccard-dense")
    work = dense.agg(F.sum(F.col("n").cast("double") * F.col("blocks"))).first()[0]
    if not work:
        return two
    sets = _whole_sets(dense.select("cls"), docs, classes, order)
    pairs = dense.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pairs = pairs.withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    tasks = F.lit(max(1, int(-(-work // DENSE_AT_ONCE))))
    pairs = pairs.withColumn("bucket", F.pmod(F.xxhash64("label", "low", "high"), tasks).cast("int"))
    met = sets.join(pairs.select("bucket", "label", "low", "high", "block", "cls", "rows"), "cls")
    sums = met.groupBy("bucket").applyInArrow(_link_sums, "cls bigint, links bigint")
    return two.union(sums.groupBy("cls").agg(F.sum("links").alias("links")))


def _links(pairs: DataFrame, docs: DataFrame, classes: DataFrame, order) -> DataFrame:
    """Those of the pairs (a, b) of classes that link. Texts of the classes are read again."""
    spark = docs.sparkSession
    pairs = stage(pairs.select("a", "b"), "jaccard-pairs")
    n = pairs.count()
    if not n:
        return spark.createDataFrame([], "a bigint, b bigint")
    ids = pairs.select(F.col("a").alias("cls")).union(pairs.select("b")).distinct()
    sets = _whole_sets(ids, docs, classes, order)

    # A centre with more than GROUP members is compared in several groups.
    sizes = pairs.groupBy("a").agg(F.count("*").alias("members"))
    salted = pairs.join(sizes, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("members") / GROUP)).cast("int"))
    tasks = max(1, -(-n // COMPARED_AT_ONCE))
    salted = salted.withColumn("bucket", F.pmod(F.xxhash64("a", "salt"), F.lit(tasks)).cast("int")).select("bucket", "a", "b")
    salted = stage(salted, "jaccard-salted")
    few = _few(salted)
    members = sets.join(few, few["b"] == sets["cls"]).select("bucket", "a", "b", "tokens")
    few = _few(salted.select("bucket", "a").distinct())
    centres = sets.join(few, few["a"] == sets["cls"]).select("bucket", "a", F.lit(None).cast("bigint").alias("b"), "tokens")
    return members.unionByName(centres).groupBy("bucket").applyInArrow(_compare, "a bigint, b bigint")


def components(links: DataFrame) -> DataFrame:
    """cls and label (the smallest class of its component) of all classes in links (a, b)."""
    edges = stage(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "links")

    def least(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    def state(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while before[0]:
        both = edges.union(edges.select("v", "u"))
        large = both.join(least(both.union(edges.select("u", F.col("u").alias("v")))), "u").where("v > u")
        large = large.select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        small = large.join(least(large), "u").select("u", "v", "m")
        small = small.select("u", F.col("m").alias("v")).union(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stage(small.where("u <> v").distinct(), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    labels = edges.select(F.col("u").alias("cls"), F.col("v").alias("label"))
    return labels.union(edges.select(F.col("v").alias("cls"), F.col("v").alias("label")).distinct())


def join(docs: DataFrame, count_links: bool = True) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, text_hash, n_shingles, component (a number), component_id (its smallest id), n_links.

    `n_links` counts the other rows that a row links with, its copies included. Without `count_links` it is left out.
    """
    with small_batches(docs.sparkSession):  # all Python work is stored before the block ends
        return _joined(docs.select("doc_id", "text"), count_links)


def _joined(docs: DataFrame, count_links: bool) -> DataFrame:
    spark = docs.sparkSession
    order = spark.sparkContext.broadcast(frequent_shingles(docs))
    rows = docs.withColumn("text_hash", F.xxhash64("text"))
    prefixes = stage(_set_rows(rows, order, False, ["doc_id", "text_hash"]), "jaccard-prefixes")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("least")
    sets = prefixes.where("n > 0").groupBy("signature").agg(least, F.count("*").alias("rows")).withColumn("cls", F.monotonically_increasing_id())
    sets = stage(sets.select("cls", "rows", F.col("signature").alias("s"), F.struct("least.doc_id", "least.text_hash").alias("member")), "jaccard-classes")
    few = _few(sets)
    one = (prefixes["signature"] == few["s"]) & prefixes["doc_id"].eqNullSafe(few["member.doc_id"]) & (prefixes["text_hash"] == few["member.text_hash"])
    classes = stage(prefixes.join(few, one).select("cls", "signature", "member", "n", "rows", "tokens"), "jaccard-classes")
    if classes.count() > sets.count():  # rows with equal ids and texts
        classes = stage(classes.dropDuplicates(["cls"]), "jaccard-classes")

    postings = _postings(classes)
    met = postings.groupBy("shingle").agg(F.count("*").alias("met")).where("met > 1")
    shared = stage(postings.join(met, "shingle"), "jaccard-shared")
    # The first centres are the classes that meet most others.
    meeting = stage(shared.groupBy("cls").agg(F.sum(1 - F.col("met")).alias("rank")), "jaccard-meeting")
    links = None
    labels = meeting.select("cls", F.col("cls").alias("label"), "rank")
    for _ in range(STAR_ROUNDS):
        found = settle(spark, lambda known=labels: _star_links(shared.join(_few(known), "cls"), docs, classes, order), "jaccard-links")
        links = found if links is None else links.union(found)
        # The classes with most links are the next centres.
        linked = links.select(F.col("a").alias("cls")).union(links.select("b")).groupBy("cls").agg((-F.count("*")).alias("rank"))
        known = stage(components(links).join(linked, "cls"), "jaccard-labels")
        labels = meeting.select("cls").join(_few(known), "cls", "left")
        labels = stage(labels.select("cls", F.coalesce("label", "cls").alias("label"), F.coalesce("rank", F.lit(0)).alias("rank")), "jaccard-ranks")
        if 5 * found.count() < meeting.count():
            break
    more = settle(spark, lambda: _last_links(shared.join(_few(labels), "cls"), docs, classes, order), "jaccard-links")
    every = links.union(more)
    joined = settle(spark, lambda: components(every), "jaccard-labels")

    named = classes.select("cls", "signature", "member.doc_id", "rows").join(joined, "cls", "left").withColumn("label", F.coalesce("label", "cls"))
    if count_links:
        counts = settle(spark, lambda: _link_counts(docs, classes, joined, order), "jaccard-link-counts")
        named = named.join(counts, "cls", "left")
    else:
        named = named.withColumn("links", F.lit(0))
    ids = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    by_set = named.join(ids, "label").select("signature", F.col("label").alias("component"), "component_id", "links", "rows")
    out = prefixes.select("doc_id", "text_hash", "n", "signature").join(by_set, "signature", "left")
    n_links = F.coalesce(F.coalesce("links", F.lit(0)) + F.col("rows") - 1, F.lit(0)).cast("bigint").alias("n_links")
    return out.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "component",
                      F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
                      *[n_links] * count_links)


def _star_links(rows: DataFrame, docs: DataFrame, classes: DataFrame, order) -> DataFrame:
    """Links of classes with the centres they meet most."""
    stars = stage(_stars(rows), "jaccard-stars")
    # A class has at most as many centres as prefix shingles.
    centres = _sized(stars, classes).groupBy("b").agg(F.collect_list(F.struct("shared", "a")).alias("all"))
    best = F.slice(F.sort_array("all", asc=False), 1, CENTRES)
    likely = _fitting(centres.select("b", F.explode(best).alias("best")).select("best.a", "b"), classes)
    return _links(likely, docs, classes, order)


def _last_links(rows: DataFrame, docs: DataFrame, classes: DataFrame, order) -> DataFrame:
    """Links between components that are left."""
    crossings = _mixed(rows).groupBy("bucket").applyInArrow(_crossings, "a bigint, b bigint, shared bigint")
    crossings = stage(crossings.select("a", "b").distinct(), "jaccard-crossings")
    return _links(_fitting(crossings, classes), docs, classes, order)


def without_copies(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id; documents with empty sets stay."""
    found = join(docs, count_links=False).where("component IS NOT NULL").select("component", "doc_id", "text_hash")
    found = stage(found, "jaccard-components")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    first = found.groupBy("component").agg(first, F.count("*").alias("n")).where("n > 1").select("component", "first", "n")
    one = (F.col("doc_id").eqNullSafe(F.col("first.doc_id"))) & (F.col("text_hash") == F.col("first.text_hash"))
    copies = found.join(first, "component").groupBy("component", "doc_id", "text_hash").agg(
        F.first(one).alias("one"), F.count("*").alias("rows"))
    copies = stage(copies, "jaccard-copies")
    kept = without(docs, copies.where(~F.col("one")).select("doc_id", "text_hash").distinct())
    again = stage(copies.where("one AND rows > 1").select("doc_id", "text_hash"), "jaccard-again")
    if again.isEmpty():
        return kept
    # Rows that are repeated whole: one of each stays.
    single = docs.join(again, same_text(docs, again), "left_semi").dropDuplicates(["doc_id", "text"])
    return without(kept, again).unionByName(single)


def _few(keys: DataFrame) -> DataFrame:
    """A stored table of numbers by class, broadcast if its size allows."""
    return F.broadcast(keys) if keys.count() <= FEW_KEYS else keys


def _sized(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs with the sizes of both, where these allow a link."""
    n = classes.select("cls", "n")
    sized = pairs.join(n.withColumnsRenamed({"cls": "a", "n": "n_a"}), "a").join(n.withColumnsRenamed({"cls": "b", "n": "n_b"}), "b")
    return sized.where(5 * F.least("n_a", "n_b") >= 4 * F.greatest("n_a", "n_b"))


def _fitting(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs whose shared prefix shingles and remaining sizes still allow a link."""

    def work(batches):
        for batch in batches:
            a, b, n_a, n_b, t_a, t_b = (c.to_pylist() for c in batch.columns)
            keep = []
            for n, m, x, y in zip(n_a, n_b, t_a, t_b):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                keep.append(shared + max(n - len(x), m - len(y)) >= needed(n, m))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = stage(pairs, "jaccard-near")
    few = _few(pairs)
    c = classes.select("cls", "n", "tokens")
    first = c.join(few, few["a"] == c["cls"]).select("a", "b", F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    second = c.join(few, few["b"] == c["cls"]).select("a", "b", F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = first.join(second, ["a", "b"])
    return both.select("a", "b", "n_a", "n_b", "t_a", "t_b").mapInArrow(work, "a bigint, b bigint")
