"""Exact Jaccard join of documents on five-word shingles by a token-group matrix (operator 10).

Two documents link when 100 * intersection >= 80 * union of their shingle sets.

1. *Classes.* Documents with equal sets are one class; its smallest id stands for it.
2. *Groups.* Classes that share a band of MinHash values with the class whose
   bands most others share (the likely original of edited copies) and look at least
   half like it are its group, whether or not they link.  Those that link with it
   are its core; the rest ask the whole group as in step 4.  Other classes are groups of
   their own.
3. *Matrix.* Shingles are put in one order (frequent ones last).  To link, two
   sets must share one of the first ``n - ceil(4n/5) + 1`` shingles of each.  The
   matrix holds, for every shingle, the groups whose union of such beginnings
   contains it, partitioned by shingle.  Summed over shingles it gives how many
   of a class's first shingles a group has, which bounds their overlap with any
   member; only groups whose bound reaches the threshold qualify.
4. *Opening.* A qualifying group's members are put into matrices of whole
   shingles, a bounded number of shingles each; the class's overlap with the union and
   then with each member is counted exactly.  Of the links in a matrix those
   that join different parts of it are kept, so their number is at most that of the classes.
5. *Components* of all links found.  Within a core all members are connected
   already, so no pair inside a core is looked at again.

The order of the shingles and the MinHash bands only decide how much work is
left for steps 3 and 4, not which links are found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.components import connected_components
from tessera.llm.minhash import shingles
from tessera.llm.text_blocks import giving_back, release_memory, text_blocks
from tessera.session import cut_lineage, forget_finished

SIGNATURE = 16
BAND_ROWS = 2
FREQUENT_IN_BLOCK = 3
DESCRIBED_BYTES = 8 << 20  # larger blocks tell more frequent shingles
MAX_FREQUENT = 1 << 17
ENTRIES_PER_BUCKET = 1_000_000
ENTRIES_AT_ONCE = 1 << 18
RELEASED_BYTES = 1 << 20  # a group of more text gives its memory back at once
PAIRS_AT_ONCE = 200_000
SHINGLES_PER_BLOCK = 200_000
DENSE_CELLS = 1 << 22
ASKED_AT_ONCE = 256
FILTER_BITS = 26
TEXTS_AT_ONCE = 256

_rng = np.random.default_rng(31)
_A = _rng.integers(0, 2 ** 31, SIGNATURE, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _rng.integers(0, 2 ** 32, SIGNATURE, dtype=np.uint32)


def _sets(text: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingles of every text."""
    x, starts = shingles(text)
    return [np.unique(x[starts[i]:starts[i + 1]]) for i in range(len(starts) - 1)]


def _node(s: np.ndarray) -> int:
    """64-bit number of a shingle set."""
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _signature(s: np.ndarray) -> bytes:
    low = (s >> np.uint64(32)).astype(np.uint32)
    return (low[None] * _A[:, None] + _B[:, None]).min(axis=1).tobytes()


def describe(docs: DataFrame) -> DataFrame:
    """One row per document (``id``, ``n``, ``node``, ``signature``), and per block of them a row with ``n`` -1 and its frequent shingles."""

    def run(batches):
        for block in text_blocks(batches, "text", DESCRIBED_BYTES):
            sets = _sets(block.column("text"))
            full = [len(s) > 0 for s in sets]
            yield pa.RecordBatch.from_arrays([
                block.column("id"), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([_node(s) if f else None for s, f in zip(sets, full, strict=True)], pa.int64()),
                pa.array([_signature(s) if f else None for s, f in zip(sets, full, strict=True)], pa.binary()),
                pa.nulls(len(sets), pa.list_(pa.int64())), pa.nulls(len(sets), pa.list_(pa.int64()))],
                names=["id", "n", "node", "signature", "shingle", "count"])
            once = {s.tobytes(): s for s in sets}
            every = np.sort(np.concatenate(list(once.values())))
            if len(every) >= FREQUENT_IN_BLOCK:  # a run of equal values that is long enough
                far = every[FREQUENT_IN_BLOCK - 1:] == every[:-FREQUENT_IN_BLOCK + 1]
                found = np.unique(every[:-FREQUENT_IN_BLOCK + 1][far])
                count = np.searchsorted(every, found, side="right") - np.searchsorted(every, found, side="left")
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, block.column("id").type), pa.array([-1], pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                    pa.array([found.view(np.int64)], pa.list_(pa.int64())), pa.array([count.astype(np.int64)], pa.list_(pa.int64()))],
                    names=["id", "n", "node", "signature", "shingle", "count"])

    return docs.mapInArrow(run, "id long, n long, node long, signature binary, shingle array<long>, count array<long>")


def frequent_shingles(described: DataFrame, most: int = MAX_FREQUENT) -> np.ndarray:
    """Frequent shingles, the rarest first: at most ``most``, for the order of the shingles only."""
    pairs = described.where("n = -1").select(F.explode(F.arrays_zip("shingle", "count")).alias("e"))
    rows = (pairs.groupBy(F.col("e.shingle").alias("s")).agg(F.sum("e.count").alias("c")).where(F.col("c") >= 2 * FREQUENT_IN_BLOCK)
            .orderBy(F.desc("c"), "s").limit(most).toPandas())
    return rows["s"].to_numpy(np.int64)[::-1].copy().view(np.uint64)


def ids_filter(ids: DataFrame, bits: int = FILTER_BITS):
    """A test of a column of ids: true for every id of ``ids`` (a column ``id``), and for a few others.

    The test holds one bit per hash value, ``2 ** bits`` in all whatever the number of ids.
    """
    spark = ids.sparkSession
    chunk = 1 << 19
    at = F.pmod(F.xxhash64("id"), F.lit(1 << bits))
    cells = ids.select(at.alias("at")).distinct().select(F.floor(F.col("at") / chunk).cast("int").alias("c"), (F.col("at") % chunk).alias("p"))

    def fill(pdf):
        flags = np.zeros(chunk, bool)
        flags[pdf["p"].to_numpy()] = True
        return pd.DataFrame({"c": pdf["c"].iloc[:1], "bits": [np.packbits(flags).tobytes()]})

    table = np.zeros((1 << bits) // 8, np.uint8)
    for r in cells.groupBy("c").applyInPandas(fill, "c int, bits binary").collect():
        table[r.c * (chunk // 8):(r.c + 1) * (chunk // 8)] = np.frombuffer(r.bits, np.uint8)
    shared = spark.sparkContext.broadcast(table)

    return IdsFilter(shared, bits)


class IdsFilter:
    """Test of ids by the bit at their hash: as a column, or inside a task on the column ``place``."""

    def __init__(self, shared, bits: int):
        self.shared, self.bits = shared, bits

    def place(self, column):
        return F.pmod(F.xxhash64(column), F.lit(1 << self.bits))

    def at(self, places: np.ndarray) -> np.ndarray:
        return (self.shared.value[places >> 3] >> (7 - (places & 7)).astype(np.uint8) & 1).astype(bool)

    def __call__(self, column):
        test = self.at

        @F.pandas_udf(T.BooleanType())
        def contains(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from giving_back(pd.Series(test(values.to_numpy(np.int64))) for values in places)

        return contains(self.place(column))


def texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of ``wanted`` (``node``, ``id``); only rows that may be wanted are shuffled."""
    wanted = cut_lineage(wanted.select("node", "id").distinct())
    may = ids_filter(wanted.select("id"))
    return docs.where(may("id")).join(wanted, "id").select("node", "text")


def in_blocks(asked: DataFrame, members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of groups and those who ask (both ``node``, ``group``), dealt to the pairs of blocks in which they meet.

    A block has about ``SHINGLES_PER_BLOCK`` shingles, so neither a large group nor one that many ask meets in one task.
    """
    n = classes.select("node", "n")
    members, asked = members.join(n, "node"), asked.join(n, "node")
    size = members.groupBy("group").agg(F.sum("n").alias("m"))
    crowd = asked.groupBy("group").agg(F.sum("n").alias("q"))
    shape = cut_lineage(size.join(crowd, "group").select(
        "group", *[F.ceil(F.col(c) / SHINGLES_PER_BLOCK).cast("int").alias(b) for c, b in (("m", "mb"), ("q", "qb"))]))

    def block(seed, count):
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(count)).cast("int")

    def every(count):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    inside = members.join(shape, "group").select("node", "group", block(1, "mb").alias("mb"), every("qb").alias("qb"), F.lit(True).alias("member"))
    outside = asked.join(shape, "group").select("node", "group", every("mb").alias("mb"), block(2, "qb").alias("qb"), F.lit(False).alias("member"))
    return cut_lineage(inside.union(outside))


def open_groups(asked: DataFrame, members: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (``a``, ``b``) of asked classes with members of groups that connect what is linked.

    ``asked``: ``node``, ``group``; ``members``: ``node``, ``group``; ``classes``: ``node``, ``n`` and ``id``, a
    document of the class.  A class may ask the group that it is a member of.
    """
    both = in_blocks(asked, members, classes)
    text = texts_of(docs, both.select("node").distinct().join(classes.select("node", "id"), "node"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sets = _sets(pa.array(pdf["text"], pa.large_string()))
        right = [_node(s) == n for s, n in zip(sets, pdf["node"], strict=True)]  # an id may stand for several texts
        own = {n: s for n, s, r, m in zip(pdf["node"], sets, right, pdf["member"], strict=True) if r and m}
        ask = {n: s for n, s, r, m in zip(pdf["node"], sets, right, pdf["member"], strict=True) if r and not m}
        large = pdf["text"].str.len().sum() > RELEASED_BYTES
        found = pd.DataFrame(matches(own, ask), columns=["a", "b"], dtype="int64")
        if large:
            del sets, own, ask, pdf
            release_memory(cycles=False)
        return found

    return both.join(text, "node").groupBy("group", "mb", "qb").applyInPandas(run, "a long, b long")


def matches(members: dict[int, np.ndarray], asked: dict[int, np.ndarray]) -> list[tuple[int, int]]:
    """Links of asked sets with members, by the members' token matrix: all but those between what others connect already.

    Tokens that many members have are columns of a dense matrix of bounded size, the others lists of members.
    """
    if not members or not asked:
        return []
    names = np.array(sorted(members), np.int64)
    sizes = np.array([len(members[n]) for n in names.tolist()])
    tokens = np.concatenate([members[n] for n in names.tolist()])
    owner = np.repeat(np.arange(len(names)), sizes)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    union, starts = np.unique(tokens, return_index=True)
    starts = np.append(starts, len(tokens))
    held = np.diff(starts)
    often = np.argsort(-held, kind="stable")[:DENSE_CELLS // len(names)]
    often = often[held[often] >= 8]
    column = np.full(len(union), -1)
    column[often] = np.arange(len(often))
    of_token = np.repeat(column, held)
    dense = np.zeros((len(names), len(often)), np.float32)
    dense[owner[of_token >= 0], of_token[of_token >= 0]] = 1
    part, out = np.arange(len(names)), []  # members with the same number are connected
    waiting = sorted(asked)
    for start in range(0, len(waiting), ASKED_AT_ONCE):
        now, found = waiting[start:start + ASKED_AT_ONCE], []
        rows = np.zeros((len(now), len(often)), np.float32)
        overlap = np.zeros((len(now), len(names)), np.float32)
        for i, node in enumerate(now):
            s = asked[node]
            at = np.searchsorted(union, s)
            at = at[(at < len(union)) & (union[np.minimum(at, len(union) - 1)] == s)]
            if 5 * len(at) < 4 * len(s):  # the overlap with the whole group is too small for any member
                continue
            found.append(i)
            rows[i, column[at[column[at] >= 0]]] = 1
            at = at[column[at] < 0]
            lo, n = starts[at], starts[at + 1] - starts[at]
            if len(at):
                ends = np.cumsum(n)
                hit = owner[np.arange(ends[-1]) + np.repeat(lo - (ends - n), n)]
                overlap[i] = np.bincount(hit, minlength=len(names))
        overlap += rows @ dense.T
        for i in found:
            node = now[i]
            linked = np.flatnonzero((9 * overlap[i] >= 4 * (sizes + len(asked[node]))) & (names != node))
            parts, first = np.unique(part[linked], return_index=True)
            itself = np.flatnonzero(names == node)
            own = part[itself]
            out += [(node, int(names[linked[f]])) for p, f in zip(parts, first) if p not in own]
            parts = np.union1d(parts, own)
            if len(parts) > 1:
                part[np.isin(part, parts)] = parts[0]
    return out


def group_classes(classes: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups (``node``, ``group``) of similar classes, named by their centre, and the links (``a``, ``b``) with the centres."""

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def bands(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def keys(signatures):
            x = np.frombuffer(b"".join(signatures), np.uint32).astype(np.uint64).reshape(-1, SIGNATURE // BAND_ROWS, BAND_ROWS)
            key = x[..., 0] << np.uint64(32) | x[..., 1]
            return pd.Series(list(key.view(np.int64)))

        yield from giving_back(map(keys, columns))

    @F.pandas_udf(T.IntegerType())
    def agree(columns: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        def equal(pair):
            x, y = (np.frombuffer(b"".join(s), np.uint32).reshape(-1, SIGNATURE) for s in pair)
            return pd.Series((x == y).sum(axis=1).astype(np.int32))

        yield from giving_back(map(equal, columns))

    every = classes.select("node", "signature", F.posexplode(bands("signature")).alias("band", "key"))
    crowd = every.groupBy("band", "key").agg(F.count("*").alias("k")).where("k > 1")
    keyed = cut_lineage(every.join(crowd, ["band", "key"]))
    # the text that others are edits of agrees with more of them than they do with each other
    popular = keyed.groupBy("node").agg((-F.sum("k")).alias("order"))
    first = (keyed.join(popular, "node").groupBy("band", "key")
             .agg(F.min(F.struct("order", "node", "signature")).alias("c")).select("band", "key", "c"))
    pairs = cut_lineage(
        keyed.join(first, ["band", "key"]).where(F.col("node") != F.col("c.node"))
        .select("node", F.col("c.node").alias("group"), agree("signature", F.col("c.signature")).alias("like"))
        .where(F.col("like") >= SIGNATURE // 2).distinct())  # others are left to the exact steps
    # a centre that has a centre itself has no group, so groups don't run together
    centres = pairs.select(F.col("group").alias("node")).distinct().join(pairs.select("node").distinct(), "node", "left_anti")
    centres = cut_lineage(centres.select("node", F.col("node").alias("group")))
    best = (pairs.join(centres.select("group"), "group").groupBy("node")
            .agg(F.min(F.struct(-F.col("like"), "group")).alias("b")).select("node", F.col("b.group").alias("group")))
    best = cut_lineage(best)
    return best.union(centres), cut_lineage(open_groups(best, centres, docs, classes))


def prefix_entries(rows: DataFrame, frequent, n_buckets: int, without: IdsFilter | None = None) -> DataFrame:
    """First shingles of every class by bucket of the shingle, packed.

    ``rows``: ``text`` and, for classes in groups, ``node``, ``group``, ``members``, ``least``, ``most``.
    A row with a ``node`` that isn't its text's is skipped.  Rows whose ``place`` is in ``without`` are left out.
    """

    def run(batches):
        order = frequent.value
        by_value = np.argsort(order)
        sorted_values = order[by_value]
        for block in text_blocks(batches, "text"):
            if without is not None:
                block = block.filter(pa.array(~without.at(block.column("place").to_numpy(zero_copy_only=False))))
            sets = _sets(block.column("text"))
            known = [block.column(c).to_pylist() for c in ("node", "group", "members", "least", "most")]
            info, tokens, owner, frequent_, seen = [], [], [], [], set()
            for i, s in enumerate(sets):
                if not len(s):
                    continue
                node = _node(s)
                grouped = known[1][i] is not None
                if known[0][i] not in (None, node) or (node, grouped) in seen:
                    continue
                seen.add((node, grouped))
                n, rank, hot = len(s), s >> np.uint64(1), np.zeros(len(s), bool)
                if len(sorted_values):
                    at = np.minimum(np.searchsorted(sorted_values, s), len(sorted_values) - 1)
                    hot = sorted_values[at] == s
                    rank = np.where(hot, np.uint64(1 << 63) | by_value[at].astype(np.uint64), rank)
                p = n - (4 * n + 4) // 5 + 1
                picked = np.argpartition(rank, p - 1)[:p] if p < n else np.arange(n)
                tokens.append(s[picked])
                frequent_.append(hot[picked])
                owner.append(np.full(p, len(info), np.uint32))
                info.append((node, n, *((x[i] for x in known[1:]) if grouped else (node, 1, n, n)), int(hot[picked].sum())))
            if not info:
                continue
            tokens, owner, info = np.concatenate(tokens), np.concatenate(owner), np.array(info, np.int64)
            frequent_ = np.concatenate(frequent_)
            bucket = (tokens % np.uint64(n_buckets)).astype(np.int64)
            by_bucket = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[by_bucket], np.arange(n_buckets + 1))
            out = {"bucket": [], "tokens": [], "owner": [], "info": []}
            for b in np.flatnonzero(np.diff(cuts)):
                part = by_bucket[cuts[b]:cuts[b + 1]]
                used, at = np.unique(owner[part], return_inverse=True)
                out["bucket"].append(int(b))
                out["tokens"].append(tokens[part].tobytes())
                # the lowest bit: a frequent shingle
                out["owner"].append((at.astype(np.uint32) * 2 + frequent_[part]).astype(np.uint32).tobytes())
                out["info"].append(info[used].tobytes())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("bucket", pa.int32()), ("tokens", pa.binary()), ("owner", pa.binary()), ("info", pa.binary())]))

    return rows.mapInArrow(run, "bucket int, tokens binary, owner binary, info binary")


def shared_counts(entries: DataFrame, n_buckets: int) -> DataFrame:
    """Shared first shingles of classes and groups, by bucket: ``node``, ``group``, ``least``, ``c``.

    ``least``: shared first shingles that a link needs, less those that were not counted.
    """

    def run(frames):
        yield from giving_back(found for bucket in _by_bucket(frames) for found in _shared(bucket))

    return (entries.repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
            .mapInPandas(run, "node long, group long, least long, c long"))


def qualifying(entries: DataFrame, n_buckets: int) -> DataFrame:
    """Classes and groups whose shared first shingles leave a link possible: ``node``, ``group``."""
    total = shared_counts(entries, n_buckets).groupBy("node", "group", "least").agg(F.sum("c").alias("c"))
    return total.where(F.col("c") >= F.col("least")).select("node", "group")


def _needed(n: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Fewest first shingles that a set of ``n`` shares with one of between ``low`` and ``high`` that it links with.

    Two sets need ``ceil(4 (n + m) / 9)`` shared ones, and at most the last
    ``ceil(4 n / 5) - 1`` (or that of ``m``) of them are not among the first.
    The first term grows by 4/9 a size and, from ``m`` = ``n`` on, the second by 4/5 but
    not at multiples of 5; so between the two sizes the number is least at an
    end or one below the upper end.
    """

    def at(m):
        return -(-4 * (n + m) // 9) - np.maximum(-(-4 * n // 5), -(-4 * m // 5)) + 1

    low, high = np.maximum(low, -(-4 * n // 5)), np.minimum(high, 5 * n // 4)
    return np.minimum(np.minimum(at(low), at(high)), at(np.maximum(low, high - 1)))


def _by_bucket(frames):
    """All packed rows of a bucket together; a bucket holds a bounded number of entries."""
    rows, now = [], None
    for pdf in frames:
        for r in pdf.itertuples(index=False):
            if r.bucket != now and rows:
                yield rows
                rows = []
            now = r.bucket
            rows.append(r)
    if rows:
        yield rows


def _shared(rows):
    """Numbers of shared first shingles of (class, group) within one bucket; the class is of the smaller group.

    A class (or one that is a group of its own) with fewer frequent shingles among
    its first ones than a link needs must share one that isn't frequent.  For such a pair only
    those are counted, and its frequent ones are taken as shared; so passages
    that very many documents share bring no pairs of documents that have more
    of their own.
    """
    tokens = np.concatenate([np.frombuffer(r.tokens, np.uint64) for r in rows])
    infos = [np.frombuffer(r.info, np.int64).reshape(-1, 7) for r in rows]
    base = np.cumsum([0] + [len(i) for i in infos])
    packed = np.concatenate([np.frombuffer(r.owner, np.uint32).astype(np.int64) + 2 * b for r, b in zip(rows, base[:-1], strict=True)])
    info = np.concatenate(infos)
    rows.clear()
    del infos
    parts = -(-len(tokens) // ENTRIES_AT_ONCE)
    if parts < 2:
        yield from _shared_part(tokens, packed, info)
        return
    part = (tokens >> np.uint64(40)) % np.uint64(parts)  # a shingle's entries stay together
    for i in range(parts):
        yield from _shared_part(tokens[part == i], packed[part == i], info)


def _shared_part(tokens, packed, info):
    """Numbers of shared ones of these first shingles, by class and group."""
    order = np.argsort(tokens, kind="stable")
    tokens, owner, hot = tokens[order], packed[order] >> 1, (packed[order] & 1).astype(bool)
    same = tokens[1:] == tokens[:-1]
    keep = np.concatenate((same, [False])) | np.concatenate(([False], same))  # shingles of one class only can't link any
    tokens, owner, hot = tokens[keep], owner[keep], hot[keep]
    if not len(tokens):
        return
    number = np.cumsum(np.concatenate(([0], tokens[1:] != tokens[:-1])))
    # one row per shingle, group and class
    node, group = info[owner, 0], info[owner, 2]
    order = np.lexsort((node, group, number))
    number, owner, node, group, hot = (x[order] for x in (number, owner, node, group, hot))
    new_group = np.concatenate(([True], (number[1:] != number[:-1]) | (group[1:] != group[:-1])))
    new_row = new_group | np.concatenate(([True], node[1:] != node[:-1]))
    at_group = owner[new_group]  # a class of every (shingle, group): it knows the group
    group_number = number[new_group]
    number, owner, hot = number[new_row], owner[new_row], hot[new_row]
    first = np.searchsorted(group_number, number, side="left")
    count = np.searchsorted(group_number, number, side="right") - first
    wide = count > 1  # shingles of one group only can't link two
    owner, hot, first, count = owner[wide], hot[wide], first[wide], count[wide]
    found: list[pd.DataFrame] = []
    pending, start = 0, 0
    ends = np.cumsum(count)
    while start < len(owner):  # a bounded number of pairs at a time
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + PAIRS_AT_ONCE, side="right")))
        n = count[start:stop]
        which = np.repeat(np.arange(start, stop), n)
        to = info[at_group[np.repeat(first[start:stop] - (np.cumsum(n) - n), n) + np.arange(n.sum())]]
        own, is_hot = info[owner[which]], hot[which]
        ok = (own[:, 3] < to[:, 3]) | ((own[:, 3] == to[:, 3]) & (own[:, 2] < to[:, 2]))
        ok &= (5 * own[:, 1] >= 4 * to[:, 4]) & (5 * to[:, 5] >= 4 * own[:, 1])
        own, to, is_hot = own[ok], to[ok], is_hot[ok]
        need = _needed(own[:, 1], to[:, 4], to[:, 5])
        frequent = np.where(to[:, 3] == 1, np.minimum(own[:, 6], to[:, 6]), own[:, 6])  # shared ones at most
        uncounted = frequent < need  # too few frequent ones to do without another
        ok = ~(is_hot & uncounted)
        least = np.where(uncounted, need - frequent, need)
        if ok.any():
            found.append(pd.DataFrame({"node": own[ok, 0], "group": to[ok, 2], "least": least[ok]})
                         .groupby(["node", "group", "least"], as_index=False).size().rename(columns={"size": "c"}))
            pending += len(found[-1])
        if pending > PAIRS_AT_ONCE:
            yield _summed(found)
            found, pending = [], 0
        start = stop
    if found:
        yield _summed(found)


def _summed(found):
    return pd.concat(found).groupby(["node", "group", "least"], as_index=False)["c"].sum()


def jaccard_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles``, ``component_id`` (smallest id reachable by links).

    Null and empty texts have no shingles and are linked with nothing; a text of
    fewer than five words is one shingle.  Equal rows stay separate rows of one
    component.  Rows without an id take no part in links and have a null
    component.  An empty table gives no rows; other columns are not read.
    """
    return _components(df, id_col, text_col).select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col), F.col("n").alias("n_shingles"), "component_id")


def _components(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per input row: ``id``, ``n``, ``node``, ``label`` (a node of the component) and ``component_id``."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    described = cut_lineage(describe(docs))
    rows = described.where("n >= 0").select("id", "n", "node", "signature")
    usable = rows.where(F.col("id").isNotNull() & F.col("node").isNotNull())
    classes = cut_lineage(usable.groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("signature").alias("signature")))
    ids = classes.select("node", "id")
    found = docs.where(F.col("id").isNotNull())

    groups, first_links = group_classes(classes, found)
    forget_finished(spark)
    sizes = groups.join(classes.select("node", "n"), "node").groupBy("group").agg(
        F.count("*").alias("members"), F.min("n").alias("least"), F.max("n").alias("most"))
    grouped = cut_lineage(groups.join(sizes, "group").select("node", "group", "members", "least", "most"))

    total = classes.agg(F.sum("n")).first()[0] or 0
    n_buckets = max(8, -(-(total // 5) // ENTRIES_PER_BUCKET))
    frequent = spark.sparkContext.broadcast(frequent_shingles(described))  # at most MAX_FREQUENT numbers
    tagged = usable.select("id", "node").join(grouped, "node").distinct()
    # an id with different texts: those without a group get a row too, so that every text meets its own
    several = usable.groupBy("id").agg(F.min("node").alias("one"), F.max("node").alias("other")).where("one <> other").select("id")
    untagged = usable.select("id", "node").distinct().join(several, "id").join(grouped.select("node"), "node", "left_anti")
    tagged = cut_lineage(tagged.select("id", "node", "group", "members", "least", "most").union(
        untagged.select("id", "node", *(F.lit(None).cast("long") for _ in range(4)))))
    may = ids_filter(tagged.select("id"))
    alone = found.select("text", may.place("id").alias("place"), *(F.lit(None).cast("long").alias(c) for c in ("node", "group", "members", "least", "most")))
    together = found.where(may("id")).join(tagged, "id", "left").select("text", "node", "group", "members", "least", "most")
    entries = prefix_entries(alone, frequent, n_buckets, may).union(prefix_entries(together, frequent, n_buckets))
    # members that don't link with their group's centre may link with others of the group
    core = first_links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    apart = grouped.select("node", "group").where("node <> group").join(core, "node", "left_anti")
    asked = cut_lineage(qualifying(entries, n_buckets).union(apart))
    forget_finished(spark)

    wanted = asked.select("group").distinct()
    single = wanted.join(grouped.select("group").distinct(), "group", "left_anti").select(F.col("group").alias("node"), "group")
    members = grouped.select("node", "group").join(wanted, "group").select("node", "group").union(single)
    links = cut_lineage(first_links.union(open_groups(asked, members, found, classes)))
    forget_finished(spark)

    label = connected_components(links)
    smallest = label.join(ids, "node").groupBy("label").agg(F.min("id").alias("component_id"))
    component = ids.join(label.join(smallest, "label").select("node", "label", "component_id"), "node", "left").select(
        "node", F.coalesce("label", "node").alias("label"), F.coalesce("component_id", "id").alias("component_id"))
    return rows.join(component, "node", "left").select(
        "id", "n", "node", "label", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))


def one_per_component(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Of every component the row with the smallest id, with all columns of ``df``.

    Rows that share an id go or stay by the component of their own text; of
    those that stay, one is kept per id and component (that with the smallest hash), and
    of those whose texts have no shingles one per id and text.  Rows without an
    id and texts without shingles are linked with nothing and stay.
    """
    columns = [F.col(f"`{c}`") for c in df.columns]

    @F.pandas_udf(T.LongType())
    def node_of(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def nodes(texts):
            out = []
            for at in range(0, len(texts), TEXTS_AT_ONCE):
                out += [_node(s) if len(s) else None for s in _sets(pa.array(texts.iloc[at:at + TEXTS_AT_ONCE], pa.large_string()))]
            return pd.Series(out, dtype="Int64")

        yield from giving_back(map(nodes, columns))

    component = cut_lineage(_components(df, id_col, text_col).where(F.col("id").isNotNull())
                            .select("id", "node", "label", (F.col("component_id") < F.col("id")).alias("goes")))
    # only rows that may be concerned are shuffled
    ids = component.groupBy("id").agg(F.max("goes").alias("goes"), F.count("*").alias("k")).where("goes or k > 1").select("id")
    concerned = component.join(ids, "id").groupBy("id", "node").agg(F.max("goes").alias("goes"), F.min("label").alias("label"))
    concerned = cut_lineage(concerned.withColumnsRenamed({"id": "known", "node": "of"}))
    may = ids_filter(concerned.select(F.col("known").alias("id")))
    rows = df.select(F.struct(*columns).alias("row"), F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    clear = rows.where(F.col("id").isNull() | ~may("id"))
    checked = (rows.where(F.col("id").isNotNull() & may("id")).select("row", "id", "text", node_of("text").alias("node"))
               .join(concerned, (F.col("id") == F.col("known")) & F.col("node").eqNullSafe(F.col("of")), "left"))
    others = checked.where(F.col("goes").isNull())
    own = F.coalesce(F.col("label").cast("string"), F.concat(F.lit("text "), "text"))
    once = checked.where(~F.col("goes")).groupBy("id", own.alias("own")).agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
    return clear.select("row.*").union(others.select("row.*")).union(once.select("row.*"))
