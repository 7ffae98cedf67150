"""Near duplicates by word shingles: MinHash signatures in an LSH forest.

Documents with equal shingle sets form one class; the rest works on classes.
A class has a signature of 128 or more MinHash values. The forest sorts the
classes by orders of these values, each starting at another place; classes that
share the first values of an order form a region of that tree. Regions get
deeper where they are dense: large ones are split by as many values more. The
number of orders and the depth follow from the similarity that makes a link:
for 0.85 there are 32 orders and regions of four and eight values.

Candidates are the neighbours with the longest common prefix in each order, and
for each region its most central class with every other one. (Copies that were
edited at different places resemble their original more than each other; it is
the class with the largest regions, and its copies are rarely its neighbours.)
Candidates whose signatures differ widely are left out, the others confirmed on
full shingle sets, best ones first; pairs that are already connected need no
confirmation. In the end, every region whose classes still lie in different
components is compared in full at the greater depth, block by block inside the
tasks, so what neighbours and centres miss is not lost: a pair at the similarity
of a link shares no such region with a chance of 1 in 1,000 at most (``missed``;
6 in 10,000 at 0.85).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.shared import staged

from .components import connected
from .frames import record_batch, shuffle_width

SHINGLE = 5  # words
LEAST_VALUES = 128  # of a signature
MOST_MISSED = 0.001  # chance that a pair just similar enough shares no deep region
DENSE = 64  # classes from which a region is split
BLOCK_ROWS, BLOCK_HASHES = 1024, 1_000_000  # of a block in which leftover classes are compared
SIMILAR = 85  # percent

_PLACES = np.random.default_rng(20240301).integers(1, 2**63, SHINGLE, np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


class Forest(NamedTuple):
    trees: int  # orders, each of which starts ``shallow`` values behind the one before
    shallow: int  # values that a region shares
    lookalike: int  # equal signature values of a candidate: 5 standard deviations less than expected

    @property
    def values(self) -> int:
        return self.trees * self.shallow

    @property
    def deep(self) -> int:  # values that a dense region shares
        return 2 * self.shallow


def missed(similarity: float, trees: int, shallow: int) -> float:
    """The chance that a pair shares no deep region, exactly.

    Orders overlap: the values are a ring of ``trees`` groups, and a deep region
    is shared where two successive groups are equal throughout.
    """
    equal = similarity**shallow
    step = np.array([[1 - equal, equal], [1 - equal, 0.0]])
    return float(np.trace(np.linalg.matrix_power(step, trees)))


@cache
def forest(percent: int) -> Forest:
    """The deepest forest of about 128 values that misses few links, or a larger one where none does."""
    if not 10 <= percent <= 100:
        raise ValueError(f"links of {percent} percent are out of range: 10 to 100")
    similarity = percent / 100
    for shallow in (4, 3, 2, 1):
        trees = -(-LEAST_VALUES // shallow)
        if missed(similarity, trees, shallow) <= MOST_MISSED:
            break
    while missed(similarity, trees, shallow) > MOST_MISSED:
        trees += 1
    values = trees * shallow
    spread = (values * similarity * (1 - similarity)) ** 0.5
    return Forest(trees, shallow, max(1, int(values * similarity - 5 * spread)))


@cache
def _hashing(values: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(1, 2**63, values, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 2**63, values, np.uint64)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z, ASCII white space
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    if n < SHINGLE:
        hashed = np.concatenate([hashed, np.full(SHINGLE - n, n, np.uint64)])
        n = SHINGLE
    sums = sum(hashed[i : n - SHINGLE + 1 + i] * _PLACES[i] for i in range(SHINGLE))
    sums = (sums ^ (sums >> np.uint64(32))) * _MIX
    return np.unique(sums ^ (sums >> np.uint64(29)))


def signature(hashes: np.ndarray, values: int = LEAST_VALUES) -> bytes:
    """MinHash values of 32 bits, big-endian."""
    multiply, add = _hashing(values)
    least = np.full(values, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(hashes), 2048):
        part = hashes[at : at + 2048]
        hashed = (part[None, :] * multiply[:, None] + add[:, None]) >> np.uint64(32)
        np.minimum(least, hashed.min(axis=1), out=least)
    return least.astype(">u4").tobytes()


def _node(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 250) -> Iterator[pa.RecordBatch]:
    """Batches cut small, so that few texts are worked on at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _signed(documents: DataFrame, values: int) -> DataFrame:
    fields = "doc_id long, row long, n_shingles long, node binary, signature binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = [shingles(text) for text in part["text"].to_pylist()]
            yield record_batch(
                fields,
                {
                    "doc_id": part["doc_id"].to_pylist(),
                    "row": part["row"].to_pylist(),
                    "n_shingles": [len(s) for s in sets],
                    "node": [_node(s) if len(s) else None for s in sets],
                    "signature": [signature(s, values) if len(s) else None for s in sets],
                },
            )

    return documents.mapInArrow(sign, fields)


def _path(shape: Forest, values: int) -> Column:
    """The first ``values`` signature values in the order of ``tree``."""
    return F.expr(f"substring(concat(signature, signature), {4 * shape.shallow} * tree + 1, {4 * values})")


def _regions(classes: DataFrame, shape: Forest) -> DataFrame:
    """(node, tree, path, region, size): the places of classes in regions of two or more."""
    trees = classes.select("node", "signature", F.explode(F.sequence(F.lit(0), F.lit(shape.trees - 1))).alias("tree"))
    keyed = trees.select("node", "tree", F.xxhash64("tree", _path(shape, shape.shallow)).alias("region"))
    shared = keyed.groupBy("region").agg(F.count("*").alias("size")).where("size > 1")
    return (
        keyed.join(shared, "region")
        .join(classes.select("node", "signature"), "node")
        .select("node", "tree", _path(shape, shape.deep).alias("path"), "region", "size")
    )


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _neighbours(regions: DataFrame, shape: Forest) -> DataFrame:
    """Pairs next to each other in a sorted order that share its first values."""
    fields = "a binary, b binary"
    keys = ("tree", "path", "node")
    shared = 4 * shape.shallow
    rows = regions.select(*keys).repartitionByRange(shuffle_width(regions), *keys).sortWithinPartitions(*keys)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = (None, b"", None)
        for batch in batches:
            found: dict[str, list] = {"a": [], "b": []}
            for tree, path, node in zip(*(batch[k].to_pylist() for k in keys)):
                if tree == last[0] and path[:shared] == last[1][:shared]:
                    found["a"].append(last[2])
                    found["b"].append(node)
                last = (tree, path, node)
            yield record_batch(fields, found)

    return rows.mapInArrow(pair, fields).select(*_ordered(F.col("a"), F.col("b")))


def _centres(regions: DataFrame) -> DataFrame:
    """Pairs of each class with the most central one of its region, at both depths."""
    weight = regions.groupBy("node").agg(F.sum(F.round(F.log2("size") * 1000).cast("long")).alias("weight"))
    weighed = regions.join(weight, "node")
    found = []
    for places, keys in ((weighed, ["region"]), (weighed.where(F.col("size") >= DENSE), ["tree", "path"])):
        top = places.groupBy(*keys).agg(F.max(F.struct("weight", "node")).alias("top"))
        found.append(places.join(top, keys).where(F.col("top.node") != F.col("node")).select(*_ordered(F.col("node"), F.col("top.node"))))
    return found[0].unionByName(found[1])


def _lookalikes(pairs: DataFrame, classes: DataFrame, shape: Forest) -> DataFrame:
    """(a, b, alike): distinct pairs whose signatures agree in enough values."""
    fields = "a binary, b binary, alike int"
    signed = (
        pairs.distinct()
        .join(classes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
        .join(classes.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
        .select("a", "b", "sa", "sb")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            one, two = (
                np.frombuffer(b"".join(batch[c].to_pylist()), ">u4").reshape(-1, shape.values) for c in ("sa", "sb")
            )
            alike = (one == two).sum(axis=1)
            keep = pa.array(alike >= shape.lookalike)
            kept = batch.filter(keep)
            yield record_batch(
                fields, {"a": kept["a"].to_pylist(), "b": kept["b"].to_pylist(), "alike": alike[alike >= shape.lookalike].tolist()}
            )

    return signed.mapInArrow(compare, fields)


def _sets(nodes: DataFrame, documents: DataFrame, sample_rows: DataFrame) -> DataFrame:
    """(node, hashes): the full shingle sets of some classes.

    Only texts of these classes are read, by the number of a row of the class.
    """
    fields = "node binary, hashes binary"
    needed = nodes.distinct().join(sample_rows, "node")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            sets = [shingles(text) for text in part["text"].to_pylist()]
            same = [(node, s.tobytes()) for node, s in zip(part["node"].to_pylist(), sets) if _node(s) == node]
            yield record_batch(fields, {"node": [n for n, _ in same], "hashes": [h for _, h in same]})

    found = documents.select("row", "text").join(needed, "row").select("node", "text").mapInArrow(collect, fields)
    return staged(found.dropDuplicates(["node"]))


def _confirmed(pairs: DataFrame, documents: DataFrame, sample_rows: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough."""
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("node")), documents, sample_rows)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            found: dict[str, list] = {"a": [], "b": []}
            for a, b, one, two in zip(*(batch[c].to_pylist() for c in ("a", "b", "ha", "hb"))):
                one, two = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                both = len(np.intersect1d(one, two, assume_unique=True))
                if 100 * both >= percent * (len(one) + len(two) - both):
                    found["a"].append(a)
                    found["b"].append(b)
            yield record_batch("a binary, b binary", found)

    return (
        pairs.select("a", "b")
        .join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("ha")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("hb")), "b")
        .select("a", "b", "ha", "hb")
        .mapInArrow(check, "a binary, b binary")
    )


def _with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """Pairs whose ends lie in different components."""
    root = lambda end: roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
    return (
        pairs.join(root("a"), "a", "left")
        .join(root("b"), "b", "left")
        .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b"))
        .select(*pairs.columns)
    )


def _links_in_block(block: pa.Table, percent: int) -> pa.Table:
    """Links of the block's ``outside`` rows with rows of other components.

    Sets are compared by look-up in a table over the block's hashes; pairs that
    are no links are never written down.
    """
    nodes, roots, outside = (block[c].to_pylist() for c in ("node", "root", "outside"))
    sets = [np.frombuffer(h, np.uint64) for h in block["hashes"].to_pylist()]
    sizes = np.array([len(s) for s in sets])
    ids = np.unique(np.concatenate(sets), return_inverse=True)[1].reshape(-1)
    starts = np.cumsum(sizes) - sizes
    component = np.unique(np.array([r.hex() for r in roots]), return_inverse=True)[1]
    mine = np.zeros(int(ids.max()) + 1, bool)
    members = np.flatnonzero(~np.array(outside))
    at = np.concatenate([np.arange(starts[m], starts[m] + sizes[m]) for m in members]) if len(members) else np.zeros(0, int)
    member_ids, member_starts = ids[at], np.cumsum(sizes[members]) - sizes[members]
    found: dict[str, list] = {"a": [], "b": []}
    for row in np.flatnonzero(np.array(outside)) if len(members) else ():
        own = ids[starts[row] : starts[row] + sizes[row]]
        mine[own] = True
        both = np.add.reduceat(mine[member_ids], member_starts, dtype=np.int64)
        mine[own] = False
        near = (100 * both >= percent * (sizes[row] + sizes[members] - both)) & (component[members] != component[row])
        for member in members[near]:
            found["a"].append(min(nodes[row], nodes[member]))
            found["b"].append(max(nodes[row], nodes[member]))
    return pa.Table.from_batches([record_batch("a binary, b binary", found)])


def _left_over_links(
    regions: DataFrame, roots: DataFrame, classes: DataFrame, documents: DataFrame, sample_rows: DataFrame, percent: int
) -> DataFrame:
    """Links between different components that share a deep region.

    In each region, the classes outside its largest component are compared with
    the classes of all others. A large region is a grid of blocks, each of which
    holds a bounded number of rows and bytes.
    """
    places = (
        regions.join(roots, "node", "left")
        .join(classes.select("node", "n_shingles"), "node")
        .select(F.xxhash64("tree", "path").alias("place"), "node", F.coalesce("root", "node").alias("root"), "n_shingles")
    )
    parts = places.groupBy("place", "root").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("hashes"))
    mixed = (
        parts.groupBy("place")
        .agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.sum("hashes").alias("hashes"))
        .where("parts > 1")
        .select("place", F.col("top.root").alias("top"), F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("hashes") / BLOCK_HASHES)).cast("int").alias("width"))
    )
    rows = staged(places.join(mixed, "place").select("place", "node", "root", "top", "width"))
    sets = _sets(rows.select("node"), documents, sample_rows)
    line = F.pmod(F.xxhash64("node"), F.col("width")).cast("int")
    across = F.sequence(F.lit(0), F.col("width") - 1)
    cells = rows.select("place", "node", "root", line.alias("i"), F.explode(across).alias("j"), F.lit(False).alias("outside")).unionByName(
        rows.where("root <> top").select("place", "node", "root", F.explode(across).alias("i"), line.alias("j"), F.lit(True).alias("outside"))
    )
    return (
        cells.join(sets, "node")
        .groupBy("place", "i", "j")
        .applyInArrow(lambda block: _links_in_block(block, percent), "a binary, b binary")
        .distinct()
    )


def _numbered(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text, row): equal rows share a number."""
    documents = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return documents.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row"))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILAR) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document.

    Texts are lower-cased (A-Z) and cut at ASCII white space; a text of one to
    four words is one shingle; null, empty and blank texts have none and are
    linked with nothing. Documents are linked when their sets' intersection is
    at least ``percent`` of their union. ``component_id`` is the smallest id that
    can be reached over links, ``kept`` tells whether it is the document's own.
    Every input row gives a row, repeated rows included. A null id is never the
    smallest; a component of nothing else has a null id and its rows are kept.
    Other columns are left out; an empty table gives an empty one.
    """
    return _judged(_numbered(df, doc_id, text), percent).drop("row", "first_row")


def _judged(documents: DataFrame, percent: int) -> DataFrame:
    """The rows of near_duplicates with their numbers and that of their component's first row.

    The first row is that of the smallest id, nulls last, then of the smallest number.
    """
    shape = forest(percent)
    signed = staged(_signed(documents, shape.values))
    grouped = staged(
        signed.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min(F.struct("row", "n_shingles", "signature")).alias("any"), F.min(F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")).alias("first"))
    )
    classes = grouped.select("node", "any.signature", "any.n_shingles")
    sample_rows = grouped.select("node", "any.row")

    regions = staged(_regions(classes, shape))
    pairs = staged(_lookalikes(_neighbours(regions, shape).unionByName(_centres(regions)), classes, shape))
    ends = pairs.select("a", "b", "alike", F.explode(F.array("a", "b")).alias("end"))
    best = staged(ends.groupBy("end").agg(F.max(F.struct("alike", "a", "b")).alias("best")).select("best.a", "best.b").distinct())
    links = staged(_confirmed(best, documents, sample_rows, percent))
    roots = connected(links)
    others = staged(_with_roots(pairs.select("a", "b").join(best, ["a", "b"], "left_anti"), roots))
    more = staged(_confirmed(others, documents, sample_rows, percent))
    if not more.isEmpty():
        links = links.unionByName(more)
        roots = connected(links)
    last = staged(_left_over_links(regions, roots, classes, documents, sample_rows, percent))
    if not last.isEmpty():
        roots = connected(links.unionByName(last))

    # Back to documents: class -> component -> smallest id.
    members = grouped.select("node", "first").join(roots, "node", "left").select("node", "first", F.coalesce("root", "node").alias("root"))
    least = members.groupBy("root").agg(F.min("first").alias("first"))
    of_class = members.select("node", "root").join(least, "root").select("node", "first")
    return (
        signed.select("doc_id", "row", "n_shingles", "node")
        .join(of_class, "node", "left")
        .select(
            "doc_id",
            "row",
            "n_shingles",
            F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
            F.when(F.col("node").isNull(), F.col("row")).otherwise(F.col("first.row")).alias("first_row"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILAR) -> DataFrame:
    """``df`` with the document of the smallest id of each group of near duplicates at ``percent``."""
    judged = _judged(_numbered(df, doc_id, text), percent)
    dropped = judged.where("NOT kept").select(F.col("row").alias("__dropped")).distinct()
    row = F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`"))
    return df.join(dropped, row == F.col("__dropped"), "left_anti")


def keep_one_of_each(df: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = SIMILAR) -> DataFrame:
    """``df`` with exactly one row of each group of near duplicates at ``percent``.

    It is the row of the smallest id, nulls last; of several texts under that id
    the one with the smallest hash. Rows equal in id and text count as one
    document, also without any words; the smallest by the other columns stays.
    Texts without words are otherwise linked with nothing and stay.
    """
    # Not near_duplicates' ``kept``: that holds for every row whose id is its component's.
    judged = _judged(_numbered(df, doc_id, text), percent)
    rows = judged.groupBy("row").agg(F.count("*").alias("n"), F.min(F.col("row") == F.col("first_row")).alias("stays"))
    marks = staged(rows.where("NOT stays OR n > 1").select(F.col("row").alias("__row"), "stays"))
    keyed = df.withColumn("__row", F.xxhash64(F.col(f"`{doc_id}`").cast("long"), F.col(f"`{text}`")))
    columns = [F.col(f"`{c}`") for c in df.columns]
    single = keyed.join(marks.select("__row"), "__row", "left_anti").select(*columns)
    repeated = marks.where("stays").select("__row")
    if repeated.isEmpty():
        return single
    # Minima are taken before the exchange, so that a row repeated very often is no hot spot.
    others = F.to_json(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in df.columns if c not in (doc_id, text)]))
    one = keyed.join(repeated, "__row", "left_semi").groupBy("__row").agg(F.min_by(F.struct(*columns), others).alias("first"))
    return single.unionByName(one.select(*[F.col(f"first.`{c}`") for c in df.columns]))
