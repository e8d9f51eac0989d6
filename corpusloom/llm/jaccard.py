"""N-gram Jaccard join with rare-first prefix, length, positional and suffix filters.

Documents with equal n-gram sets are one class. Every class sends the n-grams of its prefix - the
rarest ones, by document counts over the whole table - to posting lists; two classes can only be similar
if they share a prefix n-gram. A candidate pair must pass the length filter, the positional filter
(what can still match behind the shared n-gram) and the suffix filter (lower bound of the symmetric
difference from counts of n-grams by hash class); each pair is then verified once on the whole sets.

Short posting lists give all their pairs. Long lists, as a large group of near copies makes them, first
link a few hubs per list to all members; of the remaining pairs only those between different
components are looked at, so a group of m near copies costs about m pairs and loses no connection.

N-grams and classes are 64-bit hashes; the counts that order n-grams are kept in a table of fixed
size, which only affects speed: any total order gives the same result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.skew import lookup_join
from ..settings import written
from . import words as W
from .components import components

BINS = 1 << 20
CHUNK = 1 << 12
#: Hash classes of the suffix filter; each is counted in a byte (saturated: the bound stays a lower one).
SUFFIX = 8
#: Bits of the parity filter: sets whose bitmaps (parity of n-grams by bit) differ in d bits differ in d
#: n-grams at least.
BITS = 1024
#: First tokens of long lists by which a class knows where it met another before.
MET = 16
#: From this count of its bin on, the posting list of an n-gram is laid out in slices.
HOT = 1 << 15
SLICES = 1024
#: Lists up to this size give all their pairs (so at most LIST/2 pairs a member).
LIST = 64
#: Members of a long list that are held against all others first.
HUBS = 8
#: Classes up to this number are picked out by a broadcast join (16 bytes a row), more by a shuffle.
BROADCAST_IDS = 1_000_000


def _sets(texts: pa.Array, size: int):
    """Row and sorted distinct n-gram hashes of each text; texts without words give none."""
    data, at = W.buffers(texts)
    for low, high in W.blocks(at):
        base = at[low]
        edges = at[low : high + 1] - base
        starts, _, h = W.spans(data[base : at[high]], edges)
        first = np.searchsorted(starts, edges)
        runs = W.windows(h, size)
        for k in range(high - low):
            a, b = int(first[k]), int(first[k + 1])
            if b - a >= size:
                yield low + k, np.unique(runs[a : b - size + 1])
            elif b > a:
                yield low + k, W.windows(h[a:b], b - a)


def _class(grams: np.ndarray) -> int:
    """Hash of a set: two commutative sums put together."""
    m = W.mix(grams)
    pair = np.array([m.sum(dtype=np.uint64), W.mix(m ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)], np.uint64)
    with np.errstate(over="ignore"):
        out = W.mix(pair[:1] * np.uint64(31) + W.mix(pair[1:]) + np.uint64(len(grams)))
    return int(out.view(np.int64)[0])


def _prefix(n: int, num: int, den: int) -> tuple[int, int]:
    """Prefix lengths for links to larger and to any partner, at similarity num/den."""
    probe = n - -(-num * n // den) + 1
    index = n - -(-2 * num * n // (num + den)) + 1
    return index, probe


def _parity(grams: np.ndarray) -> bytes:
    """BITS bits: whether an odd number of n-grams fall on each."""
    odd = np.bincount((W.mix(grams) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(bool)).tobytes()


class NgramJoin:
    """``num``/``den``: least similarity; ``size``: words of an n-gram."""

    def __init__(self, docs: DataFrame, size: int = 5, num: int = 4, den: int = 5):
        self.docs, self.size, self.num, self.den = docs.select("doc_id", "text"), size, num, den
        self.id_type = docs.schema["doc_id"].dataType.simpleString()
        first = written(self._first_pass())
        #: one row per document: doc_id, tie (hash of its text), n (set size), c (class; NULL without words)
        self.rows = first.where("chunk is null").select("doc_id", "tie", "n", "c")
        kinds = first.where("chunk is null and n > 0").groupBy("c")
        self.classes = written(kinds.agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("body").alias("parity")))
        self._order = self._load_order(first)

    def _first_pass(self) -> DataFrame:
        size = self.size

        def look(batches):
            counts = np.zeros(BINS, np.uint32)
            seen = set()
            for batch in batches:
                n = [0] * batch.num_rows
                c: list[int | None] = [None] * batch.num_rows
                parity: list[bytes | None] = [None] * batch.num_rows
                for row, grams in _sets(batch.column(1), size):
                    n[row], c[row], parity[row] = len(grams), _class(grams), _parity(grams)
                    if c[row] not in seen:
                        seen.add(c[row])
                        counts[(grams & np.uint64(BINS - 1)).astype(np.int64)] += np.uint32(1)
                rows = batch.num_rows
                yield pa.record_batch(
                    [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(c, pa.int64()), pa.nulls(rows, pa.int32()), pa.array(parity, pa.binary())],
                    names=["doc_id", "tie", "n", "c", "chunk", "body"],
                )
            k = BINS // CHUNK
            empty = lambda t: pa.nulls(k, t)
            yield pa.record_batch(
                [empty(id_type), empty(pa.int64()), empty(pa.int64()), empty(pa.int64()), pa.array(range(k), pa.int32()), pa.array([p.tobytes() for p in counts.reshape(k, CHUNK)], pa.binary())],
                names=["doc_id", "tie", "n", "c", "chunk", "body"],
            )

        from pyspark.sql.pandas.types import to_arrow_type

        id_type = to_arrow_type(self.docs.schema["doc_id"].dataType)
        source = self.docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
        return source.mapInArrow(look, f"doc_id {self.id_type}, tie long, n long, c long, chunk int, body binary")

    def _load_order(self, first: DataFrame) -> np.ndarray:
        """How many classes (per task) have an n-gram, by bin; the sums of all tasks, in two levels."""

        def added(part):
            total = np.zeros(CHUNK, np.uint64)
            for body in part["body"]:
                total += np.frombuffer(body, np.uint32)
            total = np.minimum(total, 2**32 - 1).astype(np.uint32)
            return part.iloc[:1].assign(body=[total.tobytes()])

        bodies = first.where("chunk is not null").select("chunk", (F.rand(1) * 64).cast("int").alias("part"), "body")
        some = bodies.groupBy("chunk", "part").applyInPandas(added, "chunk int, part int, body binary")
        whole = some.groupBy("chunk").applyInPandas(added, "chunk int, part int, body binary")
        order = np.zeros(BINS, np.uint32)
        for r in whole.collect():  # BINS / CHUNK rows of 16 KiB
            order[r.chunk * CHUNK : (r.chunk + 1) * CHUNK] = np.frombuffer(r.body, np.uint32)
        return order

    def postings(self) -> DataFrame:
        """Prefix n-grams that two or more classes have: token, c, n, pos, tail (suffix counts), m (list size).

        One shuffle brings a token's entries together and drops lone ones. Tokens whose bin count
        says that their list may be long are spread over slices instead and kept in any case.
        """
        size, num, den = self.size, self.num, self.den
        order = self.docs.sparkSession.sparkContext.broadcast(self._order)

        def emit(batches):
            seen = set()
            shifts = np.arange(SUFFIX, dtype=np.uint64) * np.uint64(8)
            for batch in batches:
                token, cs, ns, pos, tail, cut = [], [], [], [], [], []
                for _, grams in _sets(batch.column(0), size):
                    c = _class(grams)
                    if c in seen:
                        continue
                    seen.add(c)
                    n = len(grams)
                    probe = _prefix(n, num, den)[1]
                    rank = order.value[(grams & np.uint64(BINS - 1)).astype(np.int64)]
                    if probe < n:
                        least = np.partition(rank, probe - 1)[probe - 1]
                        near = np.flatnonzero(rank <= least)
                    else:
                        near = np.arange(n)
                    near = near[np.lexsort((grams[near], rank[near]))][:probe]
                    token.append(grams[near])
                    cs.append(np.full(probe, c, np.int64))
                    ns.append(np.full(probe, n, np.int32))
                    pos.append(np.arange(probe, dtype=np.int32))
                    counts = np.bincount((grams >> np.uint64(61)).astype(np.int64), minlength=SUFFIX)
                    packed = (np.minimum(counts, 255).astype(np.uint64) << shifts).sum(dtype=np.uint64)
                    tail.append(np.full(probe, packed, np.uint64))
                    cut.append(np.where(rank[near] >= HOT, 1 + (c % SLICES), 0).astype(np.int32))
                if token:
                    yield pa.record_batch(
                        [
                            pa.array(np.concatenate(token).view(np.int64)),
                            pa.array(np.concatenate(cut)),
                            pa.array(np.concatenate(cs)),
                            pa.array(np.concatenate(ns)),
                            pa.array(np.concatenate(pos)),
                            pa.array(np.concatenate(tail).view(np.int64)),
                        ],
                        names=["token", "cut", "c", "n", "pos", "tail"],
                    )

        entries = self.docs.select("text").mapInArrow(emit, "token long, cut int, c long, n int, pos int, tail long")
        here = Window.partitionBy("token", "cut")
        shared = entries.withColumn("low", F.min("c").over(here)).withColumn("high", F.max("c").over(here))
        shared = shared.where("low < high or cut > 0").groupBy("token", "cut", "c")
        shared = written(shared.agg(*[F.min(x).alias(x) for x in ("n", "pos", "tail")]))
        sizes = shared.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
        return written(shared.join(sizes, "token").drop("cut"))

    def _passes(self, x: str, y: str) -> Column:
        """All filters for a pair of posting entries of one token."""
        num, den = self.num, self.den
        nx, ny, px, py = (F.col(f"{s}.{f}").cast("long") for f in ("n", "pos") for s in (x, y))
        short, long = F.least(nx, ny), F.greatest(nx, ny)
        overlap = F.ceil((nx + ny) * num / (num + den) - F.lit(1e-9))
        index = lambda n: n - F.ceil(n * (2 * num) / (num + den) - F.lit(1e-9)) + 1
        first = F.when(nx < ny, px < index(nx)).when(ny < nx, py < index(ny)).otherwise(F.least(px, py) < index(nx))
        behind = 1 + F.least(nx - px - 1, ny - py - 1)
        byte = lambda side, k: F.shiftrightunsigned(F.col(f"{side}.tail"), 8 * k).bitwiseAND(F.lit(255))
        apart = sum((F.abs(byte(x, k) - byte(y, k)) for k in range(SUFFIX)), F.lit(0))
        return (
            (short * den >= long * num)
            & first
            & (behind >= overlap)  # at the first n-gram they share, as any pair meets one
            & (apart <= nx + ny - 2 * overlap)
        )

    def _grams(self, ids: DataFrame) -> DataFrame:
        """c and n-gram set of the classes in ``ids`` (c), from one document of each."""
        size = self.size

        def emit(batches):
            for batch in batches:
                c, grams = [], []
                for _, g in _sets(batch.column(0), size):
                    c.append(_class(g))
                    grams.append(g.view(np.int64))
                yield pa.record_batch([pa.array(c, pa.int64()), pa.array(grams, pa.list_(pa.int64()))], names=["c", "grams"])

        wanted = written(self.classes.join(ids, "c").select(F.col("doc_id").alias("w")).distinct())
        if wanted.count() <= BROADCAST_IDS:
            wanted = F.broadcast(wanted)
        docs = self.docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("w")), "left_semi")
        return written(docs.select("text").mapInArrow(emit, "c long, grams array<bigint>"))

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The candidate pairs (u, v, any multiplicity) that are similar, with ``shared`` and both sizes."""
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        side = lambda x: self.classes.select(F.col("c").alias(x), F.col("n").alias(f"n{x}"), F.col("parity").alias(f"p{x}"))
        total = F.col("nu") + F.col("nv")
        most = total - 2 * F.ceil(total * self.num / (self.num + self.den) - F.lit(1e-9))

        def apart(batches):
            for batch in batches:
                x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, BITS // 8) for k in (3, 4))
                differ = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
                near = pa.array(differ <= np.asarray(batch.column(2)))
                yield pa.record_batch([batch.column(0).filter(near), batch.column(1).filter(near)], names=["u", "v"])

        pairs = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", most.cast("long").alias("most"), "pu", "pv")
        pairs = written(pairs.mapInArrow(apart, "u long, v long"))
        sets = self._grams(pairs.select(F.col("u").alias("c")).unionAll(pairs.select("v")).distinct())
        a = sets.select(F.col("c").alias("u"), F.col("grams").alias("a"))
        b = sets.select(F.col("c").alias("v"), F.col("grams").alias("b"))
        both = pairs.join(a, "u").join(b, "v").select(
            "u", "v", F.size("a").alias("nu"), F.size("b").alias("nv"), F.size(F.array_intersect("a", "b")).alias("shared")
        )
        return both.where(
            F.col("shared").cast("long") * self.den >= (F.col("nu") + F.col("nv") - F.col("shared")).cast("long") * self.num
        )

    def links(self) -> DataFrame:
        """Verified links between classes (u, v): all links of short lists, and of long lists enough to
        connect whatever any links would connect."""
        lists = self.postings()
        x, y = lists.alias("x"), lists.alias("y")
        pair = [F.col("x.c").alias("u"), F.col("y.c").alias("v")]
        short = x.where(f"m <= {LIST}").join(
            y.where(f"m <= {LIST}"), (F.col("x.token") == F.col("y.token")) & (F.col("x.c") < F.col("y.c")) & self._passes("x", "y")
        )
        candidates = short.select(*pair)
        long = lists.where(f"m > {LIST}")
        if not long.limit(1).count():
            return written(self._verified(candidates).select("u", "v"))
        candidates = candidates.unionAll(self._stars(long))
        links = written(self._verified(candidates).select("u", "v"))
        return links.unionAll(self._rest(self._open(long, links)))

    def _stars(self, long: DataFrame) -> DataFrame:
        """Pairs of each list's hubs with its members. Hubs are the members with the fewest rarer n-grams
        before this one, which are those with the least of their own; lists of the same members mostly have
        the same hubs. They are found first within slices of a list."""
        ranked = F.sort_array(F.collect_list("e"))
        fields = [c for c in long.columns if c != "token"]
        hubs = long.select("token", F.struct(F.col("pos").alias("rank"), F.xxhash64("c", F.lit("hub")).alias("h"), *fields).alias("e"))
        for keys in (["token", "slice"], ["token"]):
            hubs = hubs.withColumn("slice", F.pmod(F.col("e.h"), F.lit(SLICES))).groupBy(*keys)
            hubs = hubs.agg(F.slice(ranked, 1, HUBS).alias("e")).select("token", F.explode("e").alias("e"))
        hubs = written(hubs.select("token", *[f"e.{c}" for c in fields]))
        same = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") != F.col("y.c")) & self._passes("x", "y")
        return long.alias("x").join(hubs.alias("y"), same).select(F.col("x.c").alias("u"), F.col("y.c").alias("v"))

    def _open(self, long: DataFrame, links: DataFrame) -> DataFrame:
        """Members of the long lists whose members are not all in one component yet, each with its
        component (root), the list's largest one (main) and the class's first long lists (met)."""
        roots = components(links)
        met = long.groupBy("c").agg(F.slice(F.sort_array(F.collect_list(F.struct("pos", "token"))), 1, MET)["token"].alias("met"))
        placed = long.join(roots.withColumnRenamed("u", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        placed = written(placed.join(met, "c"))
        parts = placed.groupBy("token", "root").agg(F.count(F.lit(1)).alias("k"))
        main = parts.groupBy("token").agg(F.max_by("root", F.struct("k", "root")).alias("main"), F.count(F.lit(1)).alias("parts"))
        return written(placed.join(main.where("parts > 1"), "token"))

    def _rest(self, open_: DataFrame) -> DataFrame:
        """Links between components that are still apart: members outside a list's largest component
        against all members of other components."""
        x, y = open_.where("root <> main").alias("x"), open_.alias("y")
        once = (F.col("y.root") == F.col("y.main")) | (F.col("x.c") < F.col("y.c"))
        # two classes meet at the first token they share; without one among their first tokens, at any
        both = F.array_intersect("x.met", "y.met")
        here = F.coalesce(F.try_element_at(both, F.lit(1)) == F.col("x.token"), F.lit(True))
        same = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") != F.col("y.root"))
        rest = x.join(y, same & once & self._passes("x", "y") & here)
        return written(self._verified(rest.select(F.col("x.c").alias("u"), F.col("y.c").alias("v"))).select("u", "v"))

    def members(self) -> DataFrame:
        """``doc_id``, ``tie``, ``n``, ``component_id`` and ``root`` (the component's class) of every document row.

        Documents without words are linked with nothing. NULL ids count as larger than any id when a
        component is named; rows that share an id are separate documents.
        """
        roots = components(self.links())
        named = self.classes.join(roots.withColumnRenamed("u", "c"), "c", "left").withColumn("root", F.coalesce("root", "c"))
        least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
        named = named.join(least, "root").select("c", "component_id", "root")
        full = self.rows.where("n > 0")
        out = lookup_join(full, written(named), ["c"], ["doc_id", "tie"])
        empty = self.rows.where("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("root", F.lit(None).cast("long"))
        columns = ["doc_id", "tie", "n", "component_id", "root"]
        return out.select(*columns).unionAll(empty.select(*columns))


def without_near_copies(docs: DataFrame, size: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """One document of every component stays: the one with the smallest id (NULL last), then the
    smallest text hash; of equal rows one. Documents without words all stay."""
    join = NgramJoin(docs, size, num, den)
    rows = written(join.members())
    rank = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie")
    words = rows.where("n > 0")
    kept = words.groupBy("root").agg(F.min(rank).alias("r"))
    kept = kept.select(F.col("r.doc_id").alias("k_id"), F.col("r.tie").alias("k_tie"))
    kept = kept.unionAll(rows.where("n = 0").select("doc_id", "tie")).distinct()
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    inner = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    t, i = F.col(names["text"]), F.col(names["doc_id"])
    # plain equality of three columns, so that the join and the removal of equal rows share one shuffle
    key = lambda id_, tie: [F.coalesce(id_.cast("string"), F.lit("")).alias("k_id"), id_.isNull().alias("k_null"), tie.alias("k_tie")]
    keys = ["k_id", "k_null", "k_tie"]
    stay = inner.select("*", *key(i, F.xxhash64(t))).join(kept.select(*key(F.col("k_id"), F.col("k_tie"))), keys, "left_semi")
    some = F.coalesce(t.rlike(W_RE), F.lit(False))
    # rows without words stay apart, each under a number of its own
    stay = stay.withColumn("k_row", F.when(some, F.lit(0)).otherwise(F.monotonically_increasing_id() + 1))
    return stay.dropDuplicates([*keys, "k_row"]).select(*[F.col(n).alias(c) for c, n in names.items()])


W_RE = r"[^\x20\x09-\x0D]"
