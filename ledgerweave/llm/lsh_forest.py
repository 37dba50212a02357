"""Near-duplicate classes by an LSH forest over MinHash signatures.

Documents with one shingle set are one class. A class representative has ``SIZE`` MinHash
values; each of ``TREES`` orders sorts the representatives by the signature, begun at another
place, so the longest common prefixes stand side by side. Two representatives that share the
first ``FIRST`` values of an order are in one region of it.

Inside a region sorted neighbours are held against each other first, which links what is alike at
whatever depth its prefixes go; then the members that are left apart from the largest group are held
against the rest. A region of more than ``REGION`` members is sorted over range partitions and cut
into blocks where the common prefixes are shortest, so dense parts get deep blocks and sparse parts
shallow ones. Blocks of a region meet only if they can hold a link that is not known yet: the share of
different signature values is a metric, so two blocks whose middles are farther apart than their
radii and the threshold allow hold none, and blocks that are one group already need no comparison.
So no pair that shares a prefix is left out, and copies cost about one comparison per member.

The links that may reach the threshold make clusters: two representatives that share a region and may
be linked are in one cluster, however many lie between them. Every member's best link is then
confirmed on the full sets, and what those leave apart inside a cluster is decided exactly, by
multiplying membership matrices in cells of bounded size. So no pair is ever a row.

At the default threshold a linked pair shares no prefix with probability under 1e-5 (1e-7 at
0.85), in crowded regions and sparse ones alike, and an estimate lies ``SLACK`` deviations below
its value with probability 2e-5.

Defined results for unusual input: null, empty and blank texts have the empty set and are
linked with nothing; a text shorter than a shingle is one shingle; rows with a null id are
returned unlinked with a null component; rows that share an id are one document in the links,
and each keeps its own set size; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerweave.llm.common import Scratch, per_batch, words_of
from ledgerweave.llm.components import components

SIZE, TREES, FIRST = 96, 24, 4
REGION = 3_000
SLACK = 4.1
BLOCK, BLOCK_SHINGLES = 2_048, 2_000_000
LARGE = 16  # groups of so many members are ruled out as a whole where they are too far away
FEW = 24  # so many members are compared all at once
OFTEN = 64  # a shingle in more sets of a cell is counted by matrix products
COLUMNS = 2_048

_random = np.random.default_rng(20_240_601)
_MULTIPLY = _random.integers(1, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FLIP = _random.integers(0, 1 << 63, SIZE, dtype=np.uint64) * np.uint64(2)
_PLACE = _random.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FOLD = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _FOLD
    return x ^ (x >> np.uint64(29))


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text."""
    known: dict[bytes, int] = {}
    out = []
    for text in texts:
        words = words_of(text)
        for word in words:
            if word not in known:
                known[word] = xxhash.xxh3_64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        span = min(width, len(words))
        if not span:
            out.append(hashes)
            continue
        total = np.zeros(len(words) - span + 1, np.uint64)
        for i in range(span):
            total += hashes[i : len(words) - span + 1 + i] * _PLACE[i]
        out.append(np.unique(_mixed(total + np.uint64(span))))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """16-bit digests of the minima of ``SIZE`` hash orders; one row per non-empty set."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    joined = np.concatenate(sets)
    out = np.empty((len(sets), SIZE), np.uint16)
    for i in range(SIZE):
        least = np.minimum.reduceat((joined ^ _FLIP[i]) * _MULTIPLY[i], starts)
        out[:, i] = (_mixed(least) >> np.uint64(48)).astype(np.uint16)
    return out


def _describe(docs: DataFrame, width: int) -> DataFrame:
    """``id, n, digest, sig`` per row; digest and signature are null for empty sets."""
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
                        ("sig", pa.binary())])

    def work(cols):
        sets = shingle_sets(cols["text"], width)
        full = [i for i, s in enumerate(sets) if len(s)]
        digest: list[bytes | None] = [None] * len(sets)
        sig: list[bytes | None] = [None] * len(sets)
        if full:
            rows = signatures([sets[i] for i in full])
            for i, row in zip(full, rows):
                digest[i] = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                sig[i] = row.tobytes()
        return {"id": cols["id"], "n": [len(s) for s in sets], "digest": digest, "sig": sig}

    return docs.mapInArrow(per_batch(work, schema), "id bigint, n bigint, digest binary, sig binary")


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, SIZE)


def _order_keys(sigs: np.ndarray, tree: int) -> np.ndarray:
    """A number for the first ``FIRST`` values of an order, different for every order."""
    places = (np.arange(FIRST) + tree * FIRST) % SIZE
    total = np.full(len(sigs), tree * 64 + FIRST, np.uint64) * _FOLD
    for place in places:
        total = _mixed(total ^ sigs[:, place].astype(np.uint64)) + _PLACE[place % 64]
    return total.view(np.int64)


def _first_keys(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        sigs, ids = _matrix(batch.column("sig")), batch.column("id")
        for tree in range(TREES):
            yield pa.RecordBatch.from_arrays(
                [pa.array(_order_keys(sigs, tree)), pa.array([tree] * len(sigs), pa.int32()), ids],
                names=["region", "tree", "id"],
            )


def _sized(keys: DataFrame) -> DataFrame:
    """Members of regions with company, and how many each region has. A region is counted where
    its members lie, and its size comes back by a join, so a hot region is no single task."""
    sizes = keys.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
    return keys.join(sizes, "region")


def _in_order(sigs: np.ndarray, tree: int) -> np.ndarray:
    """Signatures as the order of a tree reads them."""
    return np.roll(sigs, -(tree * FIRST) % SIZE, axis=1)


def _shared_prefix(sigs: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row and the one after it."""
    different = sigs[1:] != sigs[:-1]
    return np.where(different.any(axis=1), different.argmax(axis=1), sigs.shape[1])


def _fits(sizes: np.ndarray, others: np.ndarray, percent: int) -> np.ndarray:
    """Whether the set sizes leave room for a link."""
    return 100 * np.minimum(sizes, others) >= percent * np.maximum(sizes, others)


def _alike(sigs: np.ndarray, sizes: np.ndarray, at: int, percent: int) -> np.ndarray:
    """Estimates of one member against all; -1 where the set sizes rule a link out."""
    alike = (sigs == sigs[at]).mean(axis=1)
    return np.where(_fits(sizes, sizes[at], percent), alike, -1.0)


class Links:
    """Links of one region with their estimates, and which members they join so far."""

    def __init__(self, names: np.ndarray):
        self.names = names.copy()  # members with one name are joined
        self.left: list[np.ndarray] = []
        self.right: list[np.ndarray] = []
        self.estimate: list[np.ndarray] = []
        self.compared = 0

    def add(self, left: np.ndarray, right: np.ndarray, estimate: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.estimate.append(estimate)

    def rename(self, old: np.ndarray, new: int) -> None:
        self.names[np.isin(self.names, old)] = new

    def table(self, ids: np.ndarray) -> pa.Table:
        a, b = (ids[np.concatenate(x).astype(np.int64)] if x else np.zeros(0, np.int64) for x in (self.left, self.right))
        estimate = np.concatenate(self.estimate) if self.estimate else np.zeros(0)
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b), "alike": estimate.astype(np.float32)})


def _sorted_neighbours(links: Links, sigs: np.ndarray, sizes: np.ndarray, least: float, percent: int) -> None:
    """Link members that stand side by side, ``sigs`` being sorted."""
    alike = (sigs[1:] == sigs[:-1]).mean(axis=1)
    near = np.flatnonzero((alike >= least) & _fits(sizes[1:], sizes[:-1], percent))
    links.compared += len(alike)
    links.add(near, near + 1, alike[near])
    # Neighbours that are linked without a break are one run.
    breaks = np.ones(len(sigs), bool)
    breaks[near + 1] = False
    links.names = np.flatnonzero(breaks)[np.cumsum(breaks) - 1]


def _reachable(links: Links, sigs: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Number of each member's large group, or -1, and which members each of these can be linked
    with. The share of different values is a metric: a member farther from a group's middle
    than its radius and the threshold allow is linked with none of the group."""
    kinds, counts = np.unique(links.names, return_counts=True)
    large = kinds[counts >= LARGE]
    number = np.full(len(sigs), -1)
    may = np.ones((len(large), len(sigs)), bool)
    for i, name in enumerate(large.tolist()):
        own = links.names == name
        number[own] = i
        apart = (sigs != sigs[np.flatnonzero(own)[own.sum() // 2]]).mean(axis=1)
        links.compared += len(sigs)
        may[i] = apart <= 1 - least + apart[own].max() + 1e-6
    return number, may


def _left_apart(links: Links, sigs: np.ndarray, sizes: np.ndarray, least: float, percent: int,
                side: np.ndarray | None = None) -> None:
    """Hold every member outside the largest group against the members of other groups that it can
    be linked with; with sides, every member of the smaller side against the other one."""
    if side is None:
        kinds, counts = np.unique(links.names, return_counts=True)
        todo = np.flatnonzero(links.names != kinds[counts.argmax()])
    else:
        todo = np.flatnonzero(side == (1 if (side == 1).sum() <= (side == 2).sum() else 2))
    if not len(todo):
        return
    number, may = _reachable(links, sigs, least)
    grouped = np.flatnonzero(number >= 0)
    for at in todo.tolist():
        open_ = links.names != links.names[at]
        open_[grouped] &= may[number[grouped], at]
        if number[at] >= 0:
            open_ &= may[number[at]]
        if side is not None:
            open_ &= side != side[at]
        others = np.flatnonzero(open_)
        if not len(others):
            continue
        links.compared += len(others)
        alike = (sigs[others] == sigs[at]).mean(axis=1)
        good = np.flatnonzero((alike >= least) & _fits(sizes[others], sizes[at], percent))
        if len(good):
            # The best link to each group it reaches.
            good = good[np.argsort(-alike[good], kind="stable")]
            reached, place = np.unique(links.names[others[good]], return_index=True)
            links.add(np.full(len(place), at), others[good[place]], alike[good[place]])
            links.rename(reached, links.names[at])


def _few(sigs: np.ndarray, sizes: np.ndarray, ids: np.ndarray, least: float, percent: int) -> pa.Table:
    """Links of a region of a few members, the best ones first, until all that may be linked are."""
    alike = (sigs[:, None, :] == sigs[None, :, :]).mean(axis=2)
    left, right = np.nonzero(np.triu((alike >= least) & _fits(sizes[:, None], sizes[None, :], percent), 1))
    links = Links(np.arange(len(ids)))
    for i in np.argsort(-alike[left, right], kind="stable").tolist():
        a, b = left[i], right[i]
        if links.names[a] != links.names[b]:
            links.add(left[i : i + 1], right[i : i + 1], alike[a, b : b + 1])
            links.rename(links.names[b], links.names[a])
    return links.table(ids)


def _spanning(least: float, percent: int):
    """Links that join all members of a region that may be linked; in a cell of two blocks,
    sides 1 and 2, those between them that ``name`` does not join already."""
    def work(region: pa.Table) -> pa.Table:
        tree = region.column("tree")[0].as_py()
        sigs = _in_order(_matrix(region.column("sig")), tree)
        side = region.column("side").to_numpy()
        if len(sigs) <= FEW and not side.any():
            return _few(sigs, region.column("n").to_numpy(), region.column("id").to_numpy(), least, percent)
        if side.any():
            order = np.arange(len(sigs))
        else:
            order = np.lexsort(sigs[:, ::-1].T)
        sigs, side = sigs[order], side[order]
        ids, sizes = region.column("id").to_numpy()[order], region.column("n").to_numpy()[order]
        if side.any():
            links = Links(np.unique(region.column("name").to_numpy(), return_inverse=True)[1])
            _left_apart(links, sigs, sizes, least, percent, side)
        else:
            links = Links(np.arange(len(ids)))
            _sorted_neighbours(links, sigs, sizes, least, percent)
            _left_apart(links, sigs, sizes, least, percent)
        return links.table(ids)

    return work


_BLOCKS = pa.schema([
    ("region", pa.int64()), ("tree", pa.int32()), ("block", pa.int64()), ("id", pa.int64()),  # a member
    ("a", pa.int64()), ("b", pa.int64()), ("alike", pa.float32()),  # or a link
    ("n", pa.int64()), ("sig", pa.binary()), ("radius", pa.float32()),  # or the block's middle member
    ("low", pa.int64()), ("high", pa.int64()),
])
_BLOCK_DDL = ("region bigint, tree int, block bigint, id bigint, a bigint, b bigint, alike float, "
              "n bigint, sig binary, radius float, low bigint, high bigint")


def _cut_blocks(least: float, percent: int, most: int):
    """Mapper of sorted members of crowded regions to blocks, their inner links and middles."""

    def block(number: int, rows: pa.Table):
        tree = rows.column("tree")[0].as_py()
        plain = _matrix(rows.column("sig"))
        sigs = _in_order(plain, tree)
        ids, sizes = rows.column("id").to_numpy(), rows.column("n").to_numpy()
        links = Links(np.arange(len(ids)))
        _sorted_neighbours(links, sigs, sizes, least, percent)
        _left_apart(links, sigs, sizes, least, percent)
        found = links.table(ids)
        middle = len(ids) // 2
        radius = float((sigs != sigs[middle]).mean(axis=1).max())
        region = rows.column("region")[0].as_py()
        total = len(ids) + found.num_rows + 1
        gap = lambda n: pa.nulls(n)

        def column(name, members, linked, centre):
            kind = _BLOCKS.field(name).type
            parts = [gap(len(ids)) if members is None else members, gap(found.num_rows) if linked is None else linked,
                     gap(1) if centre is None else centre]
            return pa.concat_arrays([pa.array(x).cast(kind) if not isinstance(x, pa.Array) else x.cast(kind) for x in parts])

        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(total, region)), pa.array(np.full(total, tree, np.int32)), pa.array(np.full(total, number)),
            column("id", ids, None, ids[middle : middle + 1]),
            column("a", None, found.column("a").to_numpy(), None), column("b", None, found.column("b").to_numpy(), None),
            column("alike", None, found.column("alike").to_numpy(), None),
            column("n", None, None, sizes[middle : middle + 1]),
            column("sig", None, None, [plain[middle].tobytes()]), column("radius", None, None, np.array([radius], np.float32)),
            column("low", None, None, sizes.min(keepdims=True)), column("high", None, None, sizes.max(keepdims=True)),
        ], schema=_BLOCKS)

    def run(batches):
        number, held = TaskContext.get().partitionId() << 33, None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            while True:
                regions = held.column("region").to_numpy()
                end = int(np.argmax(regions != regions[0])) or len(regions)
                if end <= most and end == len(regions):
                    break  # it may go on in the next batch
                if end > most:  # cut where the common prefix is shortest
                    sigs = _in_order(_matrix(held.column("sig").slice(0, most + 1)), held.column("tree")[0].as_py())
                    half = most // 2
                    end = half + 1 + int(_shared_prefix(sigs[half:]).argmin())
                yield from block(number, held.slice(0, end))
                number, held = number + 1, held.slice(end)
                if not held.num_rows:
                    held = None
                    break
            if held is not None:
                held = held.combine_chunks()
        if held is not None and held.num_rows:
            yield from block(number, held)

    return run


def _meeting(least: float, percent: int):
    """Of pairs of blocks, those that can hold a link, and the links between their middles."""
    def work(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            at = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names if not c.startswith("sig")}
            apart = (_matrix(batch.column("sig")) != _matrix(batch.column("sig_2"))).mean(axis=1)
            fits = 100 * at["high"] >= percent * at["low_2"]
            fits &= 100 * at["high_2"] >= percent * at["low"]
            # Rounding of the share must not rule a pair out.
            may = fits & (apart <= 1 - least + at["radius"] + at["radius_2"] + 1e-6)
            near = (1 - apart >= least) & _fits(at["n"], at["n_2"], percent)
            keep = may | near
            yield pa.RecordBatch.from_arrays(
                [pa.array(at[c][keep]) for c in ("region", "tree", "block", "block_2", "id", "id_2")]
                + [pa.array(may[keep]), pa.array(near[keep]), pa.array((1 - apart[keep]).astype(np.float32))],
                names=["region", "tree", "block", "block_2", "a", "b", "may", "near", "alike"],
            )

    return work


def _regions(
    reps: DataFrame, scratch: Scratch, least: float, percent: int
) -> tuple[DataFrame, DataFrame | None]:
    """``region, tree, side, id, name`` of small regions and of the cells that crowded ones need,
    and the links already known in crowded ones."""
    fields = "region bigint, tree int, id bigint"
    level = scratch.write(
        "level", _sized(reps.select("id", "sig").mapInArrow(_first_keys, fields))
    )
    none = F.lit(0).cast("bigint")
    small = level.where(F.col("size") <= REGION).select("region", "tree", F.lit(0).alias("side"), "id", none.alias("name"))
    crowded = level.where(F.col("size") > REGION)
    if crowded.isEmpty():
        return small, None
    most = max(2, REGION // 2)
    # The signature as the order of the tree reads it; equal prefixes stand together.
    start = F.col("tree") * (2 * FIRST)
    turned = F.concat(
        F.substring("sig", start + 1, F.lit(2 * SIZE)), F.substring("sig", F.lit(1), start)
    )
    known = crowded.join(reps, "id").select("region", "tree", "id", "n", "sig", turned.alias("order"))
    members = known.select(F.count("*").alias("n")).first()["n"]
    ranges = max(int(reps.sparkSession.conf.get("spark.sql.shuffle.partitions")), members // 200_000)
    ordered = known.repartitionByRange(ranges, "region", "order", "id").sortWithinPartitions("region", "order", "id")
    blocks = scratch.write("blocks", ordered.drop("order").mapInArrow(_cut_blocks(least, percent, most), _BLOCK_DDL))
    middles = blocks.where("sig IS NOT NULL").select("region", "tree", "block", "id", "n", "sig", "radius", "low", "high")
    later = middles.drop("tree").withColumnsRenamed({c: f"{c}_2" for c in middles.columns if c not in ("region", "tree")})
    pairs = middles.join(later, "region").where("block < block_2")
    met = scratch.write("met", pairs.mapInArrow(_meeting(least, percent), (
        "region bigint, tree int, block bigint, block_2 bigint, a bigint, b bigint, may boolean, near boolean, alike float"
    )))
    links = scratch.write("inner", blocks.where("a IS NOT NULL").select("a", "b", "alike").unionByName(
        met.where("near").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "alike")
    ))
    # What each member is joined with so far, and the blocks that are one group altogether.
    groups = components(links.select("a", "b"), scratch, "inner-groups")
    named = blocks.where("id IS NOT NULL AND sig IS NULL").select("block", "id").join(
        groups.withColumnRenamed("node", "id"), "id", "left"
    ).select("block", "id", F.coalesce("root", "id").alias("name"))
    named = scratch.write("named", named)
    one = scratch.write("one", named.groupBy("block").agg(
        F.min("name").alias("name"), (F.min("name") == F.max("name")).alias("whole")
    ))
    first, second = one.alias("x"), one.alias("y")
    open_ = met.where("may").join(first, F.col("x.block") == met["block"]).join(
        second, F.col("y.block") == F.col("block_2")
    ).where(~(F.col("x.whole") & F.col("y.whole") & (F.col("x.name") == F.col("y.name"))))
    cells = open_.select(
        F.xxhash64("region", met["block"], "block_2").alias("region"), "tree",
        F.inline(F.array(F.struct(met["block"].alias("block"), F.lit(1).alias("side")),
                         F.struct(F.col("block_2").alias("block"), F.lit(2).alias("side")))),
    )
    dealt = cells.join(named, "block").select("region", "tree", "side", "id", "name")
    return small.unionByName(dealt), links


def _shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all left sets with all right sets.

    Shingles in many sets go through matrix products, a bounded number of shingles at a time;
    those in few sets add one to each of their few pairs.
    """
    values, place = np.unique(np.concatenate(left + right), return_inverse=True)
    n_left = sum(map(len, left))
    rows = np.repeat(np.arange(len(left)), [len(s) for s in left])
    cols = np.repeat(np.arange(len(right)), [len(s) for s in right])
    at_left, at_right = place[:n_left], place[n_left:]
    in_left = np.bincount(at_left, minlength=len(values))
    in_right = np.bincount(at_right, minlength=len(values))
    counts = np.zeros((len(left), len(right)), np.float32)
    both = (in_left > 0) & (in_right > 0)
    often = both & (in_left + in_right > OFTEN)
    # Frequent shingles: dense blocks.
    number = np.cumsum(often) - 1
    pick_left, pick_right = often[at_left], often[at_right]
    l_row, l_col = rows[pick_left], number[at_left[pick_left]]
    r_row, r_col = cols[pick_right], number[at_right[pick_right]]
    l_order, r_order = np.argsort(l_col, kind="stable"), np.argsort(r_col, kind="stable")
    l_row, l_col, r_row, r_col = l_row[l_order], l_col[l_order], r_row[r_order], r_col[r_order]
    for start in range(0, int(often.sum()), COLUMNS):
        l_part = slice(*np.searchsorted(l_col, [start, start + COLUMNS]))
        r_part = slice(*np.searchsorted(r_col, [start, start + COLUMNS]))
        x = np.zeros((len(left), COLUMNS), np.float32)
        y = np.zeros((len(right), COLUMNS), np.float32)
        x[l_row[l_part], l_col[l_part] - start] = 1
        y[r_row[r_part], r_col[r_part] - start] = 1
        counts += x @ y.T
    # Rare shingles: every left holder meets every right holder, at most OFTEN of either.
    rare = both & ~often
    pick_left, pick_right = rare[at_left], rare[at_right]
    l_key, l_row = at_left[pick_left], rows[pick_left]
    r_key, r_row = at_right[pick_right], cols[pick_right]
    r_order = np.argsort(r_key, kind="stable")
    r_key, r_row = r_key[r_order], r_row[r_order]
    for start in range(0, len(l_key), 1 << 17):
        key, row = l_key[start : start + (1 << 17)], l_row[start : start + (1 << 17)]
        low, many = np.searchsorted(r_key, key), in_right[key]
        step = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        cells = np.repeat(row, many) * len(right) + r_row[np.repeat(low, many) + step]
        counts += np.bincount(cells, minlength=counts.size).reshape(counts.shape)
    return counts


def _confirmed(percent: int):
    """Of listed pairs with both full sets, those that are linked."""
    def work(batches):
        for batch in batches:
            keep = []
            for left, right in zip(batch.column("left"), batch.column("right")):
                x, y = (np.frombuffer(m.as_buffer(), np.uint64) for m in (left, right))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return work


def _exact_links(percent: int):
    """Spanning links of one cell: all its pairs decided on the full sets. Members with one
    ``name`` are linked already."""
    def work(cell: pa.Table) -> pa.Table:
        ids, block = cell.column("id").to_numpy(), cell.column("block").to_numpy()
        known = cell.column("name").to_numpy()
        sets = [np.frombuffer(m, np.uint64) for m in cell.column("members").to_pylist()]
        low, high = cell.column("low")[0].as_py(), cell.column("high")[0].as_py()
        side = [np.flatnonzero(block == b) for b in (low, high)]
        if not len(side[0]) or not len(side[1]):
            return pa.table({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64)})
        counts = _shared_counts(*([sets[i] for i in s] for s in side))
        sizes = [np.array([len(sets[i]) for i in s], np.float64) for s in side]
        union = sizes[0][:, None] + sizes[1][None, :] - counts
        linked = 100 * counts.astype(np.float64) >= percent * union
        linked |= known[side[0]][:, None] == known[side[1]][None, :]
        names = [ids[s].copy() for s in side]
        far = np.iinfo(np.int64).max
        while True:  # the smallest id reached spreads until nothing changes
            first = np.minimum(names[0], np.where(linked, names[1][None, :], far).min(axis=1))
            second = np.minimum(names[1], np.where(linked, first[:, None], far).min(axis=0))
            if low == high:
                first = second = np.minimum(first, second)
            if (first == names[0]).all() and (second == names[1]).all():
                break
            names = [first, second]
        a, b = np.concatenate(names), np.concatenate([ids[s] for s in side])
        return pa.table({"a": a[a != b], "b": b[a != b]})

    return work


def _cells(members: DataFrame, reps: DataFrame) -> DataFrame:
    """``root, low, high, block, id, name``: members of clusters that are several groups yet, dealt
    into blocks, and each pair of blocks one cell.

    ``members`` has ``root, id, name``. Members of a cluster's largest group need no comparison with
    one another, so they get blocks of their own and meet the others only. A block holds about
    ``BLOCK`` members and ``BLOCK_SHINGLES`` shingles.
    """
    known = members.join(reps.select("id", "n"), "id")
    groups = known.groupBy("root", "name").agg(F.count("*").alias("members"))
    largest = groups.groupBy("root").agg(
        F.max_by("name", F.struct("members", "name")).alias("main")
    ).select(F.col("root").alias("several"), "main")
    known = known.join(largest, F.col("root") == F.col("several")).withColumn("inside", F.col("name") == F.col("main"))
    sizes = known.groupBy("several", "inside").agg(F.count("*").alias("members"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("members") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES))
    sizes = sizes.groupBy("several").agg(
        F.coalesce(F.max(F.when(~F.col("inside"), blocks)), F.lit(0)).alias("apart"),
        F.coalesce(F.max(F.when(F.col("inside"), blocks)), F.lit(0)).alias("main_blocks"),
    )
    dealt = known.join(sizes, "several").select(
        "root", "id", "name", "inside", "apart", "main_blocks",
        F.when(F.col("inside"), F.col("apart") + F.pmod(F.xxhash64("id"), F.col("main_blocks")))
        .otherwise(F.pmod(F.xxhash64("id"), F.col("apart"))).alias("block"),
    )
    met = F.when(F.col("inside"), F.col("apart")).otherwise(F.col("apart") + F.col("main_blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), (met - 1).cast("bigint"))).alias("other")
    return dealt.select("root", "id", "name", "block", other).select(
        "root", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "id", "name",
    )


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5,
                    percent: int = 80) -> DataFrame:
    """``key, n_shingles, component_id, kept``: one row per row of ``docs``.

    Two documents are linked if their word shingles of ``width`` have a Jaccard similarity of
    at least ``percent`` / 100; a component is known by its smallest id, which is the one kept.
    """
    scratch = Scratch(docs.sparkSession, "lsh-forest")
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    described = scratch.write("described", _describe(rows, width))
    linkable = described.where("id IS NOT NULL AND digest IS NOT NULL")
    classes = scratch.write(
        "classes",
        linkable.groupBy("digest").agg(
            F.min("id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig")
        ),
    )
    # Ids that repeat can stand for several classes, which are one document then.
    reps = classes.groupBy(F.col("rep").alias("id")).agg(
        F.max("n").alias("n"), F.max_by("sig", "n").alias("sig")
    )
    share = percent / 100
    least = share - SLACK * (share * (1 - share) / SIZE) ** 0.5
    members, inner = _regions(reps, scratch, least, percent)
    found = members.join(reps, "id").groupBy("region").applyInArrow(
        _spanning(least, percent), "a bigint, b bigint, alike float"
    )
    if inner is not None:
        found = found.unionByName(inner)
    found = scratch.write("found", found)
    nodes = scratch.write("nodes", found.select(F.col("a").alias("id")).union(found.select("b")).distinct())
    schema = pa.schema([("id", pa.int64()), ("members", pa.binary())])

    def sets(cols):
        return {"id": cols["id"],
                "members": [s.tobytes() for s in shingle_sets(cols["text"], width)]}

    needed = scratch.write("sets", rows.join(nodes, "id", "left_semi").mapInArrow(
        per_batch(sets, schema), "id bigint, members binary"
    ))
    # Every member's best link to a smaller id is confirmed; where these join all, all is done.
    best = found.groupBy("b").agg(F.max_by("a", F.struct("alike", "a")).alias("a"))
    left = needed.select(F.col("id").alias("a"), F.col("members").alias("left"))
    right = needed.select(F.col("id").alias("b"), F.col("members").alias("right"))
    sure = scratch.write("sure", best.join(right, "b").join(left, "a").mapInArrow(
        _confirmed(percent), "a bigint, b bigint"
    ))
    joined = scratch.write("joined", components(sure, scratch, "joined-groups"))
    names = scratch.write("names", nodes.join(joined.withColumnRenamed("node", "id"), "id", "left").select(
        "id", F.coalesce("root", "id").alias("name")
    ))
    # Links that may hold between two groups make clusters of groups, which are decided exactly.
    ends = [names.select(F.col("id").alias(c), F.col("name").alias(f"name_{c}")) for c in "ab"]
    open_ = found.select("a", "b").join(ends[0], "a").join(ends[1], "b").where("name_a <> name_b").select(
        F.col("name_a").alias("a"), F.col("name_b").alias("b")
    )
    clusters = scratch.write("clusters", components(open_, scratch, "cluster"))
    roots = joined
    if not clusters.isEmpty():
        members = names.join(clusters.withColumnRenamed("node", "name"), "name").select("root", "id", "name")
        links = _cells(members, reps).join(needed, "id").groupBy("root", "low", "high").applyInArrow(
            _exact_links(percent), "a bigint, b bigint"
        )
        between = links.join(ends[0], "a").join(ends[1], "b").select(
            F.col("name_a").alias("a"), F.col("name_b").alias("b")
        )
        last = components(between, scratch, "root").select(F.col("node").alias("name"), F.col("root").alias("last"))
        roots = names.join(last, "name", "left").select(
            F.col("id").alias("node"), F.coalesce("last", "name").alias("root")
        )
    named = classes.select("digest", "rep").join(
        roots.withColumnRenamed("node", "rep"), "rep", "left"
    ).select("digest", F.coalesce("root", "rep").alias("component_id"))
    result = described.select("id", "n", "digest").join(named, "digest", "left").select(
        F.col("id").alias(key), F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("id")).otherwise(F.col("component_id"))
        .alias("component_id"),
    ).withColumn("component_id", F.when(F.col(key).isNotNull(), F.col("component_id"))
    ).withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    done = scratch.write("result", result)
    scratch.drop(
        "described", "classes", "clusters", "level", "blocks", "met", "inner", "named", "one", "found", "nodes", "sets",
        "sure", "joined", "names",
    )
    return done
