"""Near-duplicate join on word shingles through signature trees.

Two documents link when the Jaccard similarity of their sets of ``SHINGLE`` -word
shingles is at least ``LEAST`` / 100. The join is exact:

1. Prefix keys. Under one order of all shingles, linked sets share one of their
   first ``n - ceil(0.8 n) + 1``. Keys travel packed, one row per slice of text
   and bucket. The order is by hash, with the most frequent shingles last (a
   bounded list), so boilerplate rarely is a key.
2. Stars. Documents with a common key are noted as members of the star of the
   smallest of them: as many rows as keys at most, never pairs within a group.
   Two linked documents share a key, hence both are members of one star.
3. Signature trees. A star's members are leaves of a tree, sorted by size; its
   nodes hold the OR of their members' token bitmaps and their range of sizes.
   A dual traversal of the tree with itself drops node pairs whose largest
   possible overlap is too small for any pair below them.
4. The members that are left fetch their sets; the trees are traversed again and
   pairs compared exactly, but for pairs that are connected already. A star
   reports one link per member, not its pairs.
5. Connected components of these links.

A star with more than ``CHUNK`` members is dealt to chunks, each with the
star's centre. Members found unconnected to the centre are then compared with
all other chunks, one pair of chunks at a time, so no link between members of
different chunks is lost and no comparison holds more than two chunks. Bitmaps
are compared first; only members of possible pairs fetch their texts. Equal sets
in a slice are one document up to here. Text is never grouped.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.llm.common import hand_off, hash_words, mix, ngram_hash, owners, slices, starts_that_fit, sum_by, texts_of, words_of
from gaugeline.llm.components import components
from gaugeline.llm.packed import pack, small, unpack
from gaugeline.llm.substrings import _ragged, first_of_equal

SHINGLE = 5
#: Least similarity, in hundredths.
LEAST = 80
#: Members of a star that one task holds at most; larger stars are dealt to chunks.
CHUNK = 2_000
#: Members that a group of small stars comes to, on average, and keys of a bucket.
GROUP_ROWS = 1_000
BUCKET_KEYS = 1_000_000
PACK_BYTES = 8 << 20
MAX_FREQUENT = 1 << 16
FANOUT = 8
NEAR = 12
_LAST = np.uint64(1 << 63)
_OTHER = np.uint64(0x2545F4914F6CDD1D)


# -- sets -------------------------------------------------------------------


def shingle_sets(texts: pa.Array, frequent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text (63-bit hashes, frequent ones last) and the texts' offsets."""
    codes, offsets, vocab = words_of(pc.ascii_lower(texts))
    hashes = hash_words(vocab)[codes]
    count = np.diff(offsets)
    at = np.flatnonzero(starts_that_fit(offsets, SHINGLE))
    doc, value = owners(offsets)[at], ngram_hash(hashes, SHINGLE)[at]
    for n in range(1, SHINGLE):  # shorter texts are one shingle
        few = np.flatnonzero(count == n)
        if len(few):
            doc = np.concatenate([doc, few])
            value = np.concatenate([value, ngram_hash(hashes, n)[offsets[few]]])
    value = value >> np.uint64(1)
    if frequent is not None and len(frequent) and len(value):
        near = np.minimum(np.searchsorted(frequent, value), len(frequent) - 1)
        value = np.where(frequent[near] == value, value | _LAST, value)
    by = np.lexsort((value, doc))
    doc, value = doc[by], value[by]
    new = np.ones(len(by), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    size = np.bincount(doc[new], minlength=len(texts)).astype(np.int64)
    return value[new], np.concatenate([[0], np.cumsum(size)])


def prefix_length(n: np.ndarray, least: int) -> np.ndarray:
    return np.where(n > 0, n - (least * n + 99) // 100 + 1, 0)


def may_link(value: np.ndarray, place: np.ndarray, doc: np.ndarray, n: np.ndarray, least: int) -> np.ndarray:
    """Which entries of a key (sorted by key, then set size) have a possible partner under it.

    Two sets must be close in size, and share no more than what stands before
    the key in both and after it in both. With up to ``NEAR`` entries a key's
    pairs are looked at for both bounds, by distance in the order; an entry of a
    longer key needs a neighbour of fitting size.
    """
    keep = np.zeros(len(value), bool)
    head = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
    entries = np.diff(np.append(head, len(value)))
    many = np.repeat(entries > NEAR, entries)
    for off in range(1, NEAR):
        i = np.flatnonzero(value[off:] == value[: len(value) - off]) if off < len(value) else np.zeros(0, np.int64)
        if off > 1:
            i = i[~many[i]]
        j = i + off
        ok = (100 * n[i] >= least * n[j]) & (doc[i] != doc[j])
        most = np.minimum(place[i], place[j]) + np.minimum(n[i] - place[i], n[j] - place[j])
        ok &= many[i] | ((100 + least) * most >= least * (n[i] + n[j]))
        keep[i[ok]] = keep[j[ok]] = True
    return keep


def linked(a: np.ndarray, b: np.ndarray, least: int) -> bool:
    """Whether two sorted sets reach the similarity, in integers."""
    if len(a) > len(b):
        a, b = b, a
    if 100 * len(a) < least * len(b):
        return False
    near = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[near] == a).sum())
    return 100 * both >= least * (len(a) + len(b) - both)


# -- signature trees --------------------------------------------------------


def bitmap(values: np.ndarray) -> np.ndarray:
    """Token bitmap as 64-bit words, 6 to 12 bits for each shingle (a power of two)."""
    width = max(64, 1 << int(6 * len(values) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(mix(values) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").view(np.uint64)


class SignatureTree:
    """Members sorted by size, all bitmaps of one width; each level has a node for ``FANOUT`` below.

    A node holds the smallest and largest size of its members, the OR of their
    bitmaps, and the largest excess: how many more tokens than bits a member has.
    """

    def __init__(self, members: np.ndarray, sizes: np.ndarray, maps: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        self.members = members[order]
        size, maps = sizes[order], maps[order]
        excess = size - np.bitwise_count(maps).sum(axis=1)
        self.levels = [(size, size, maps, excess)]
        while len(size) > 1:
            low, high, maps, excess = self.levels[-1]
            heads = np.arange(0, len(low), FANOUT)
            size = np.minimum.reduceat(low, heads)
            self.levels.append(
                (size, np.maximum.reduceat(high, heads), np.bitwise_or.reduceat(maps, heads, axis=0), np.maximum.reduceat(excess, heads))
            )


def _possible(a, b, p: np.ndarray, q: np.ndarray, least: int) -> np.ndarray:
    """Node pairs some pair below which may still reach the similarity.

    A common token sets a bit in both bitmaps, so an overlap is at most the
    common bits plus the smaller excess; it must be ``s / (1 + s)`` of both sizes.
    """
    ok = (100 * a[1][p] >= least * b[0][q]) & (100 * b[1][q] >= least * a[0][p])
    block = max(1, (1 << 20) // a[2].shape[1])
    for lo in range(0, len(p), block):
        at = lo + np.flatnonzero(ok[lo : lo + block])
        common = np.bitwise_count(a[2][p[at]] & b[2][q[at]]).sum(axis=1, dtype=np.int64)
        most = common + np.minimum(a[3][p[at]], b[3][q[at]])
        ok[at] = (100 + least) * most >= least * (a[0][p[at]] + b[0][q[at]])
    return ok


def _below(tree: SignatureTree, level: int, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair once for every child of its first node."""
    start = p * FANOUT
    count = np.minimum(start + FANOUT, len(tree.levels[level - 1][0])) - start
    return _ragged(start, count), np.repeat(q, count)


def dual_traversal(a: SignatureTree, b: SignatureTree, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members, one of each tree (or two of one), that the bounds do not exclude."""
    la, lb = len(a.levels) - 1, len(b.levels) - 1
    p = q = np.zeros(1, np.int64)
    while True:
        if a is not b or la == 0:  # a node and itself always stay
            ok = _possible(a.levels[la], b.levels[lb], p, q, least)
            p, q = p[ok], q[ok]
        else:
            ok = (p == q) | _possible(a.levels[la], b.levels[lb], p, q, least)
            p, q = p[ok], q[ok]
        if la == lb == 0 or not len(p):
            break
        ta, tb = la, lb
        if ta >= tb:
            p, q = _below(a, la, p, q)
            la -= 1
        if tb >= ta:
            q, p = _below(b, lb, q, p)
            lb -= 1
        if a is b:
            p, q = p[p <= q], q[p <= q]
    if a is b:
        p, q = p[p != q], q[p != q]
    return a.members[p], b.members[q]


def possible_pairs(sizes: np.ndarray, maps: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Possible pairs of a star: a tree for each bitmap width, against itself and the next width folded.

    Widths follow sizes in steps of two, so sets that can link differ by one
    step at most (for similarities of one half and more).
    """
    width = np.array([len(m) for m in maps])
    left, right, trees = [], [], {}
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        trees[int(w)] = SignatureTree(at, sizes[at], np.stack([maps[i] for i in at]))
    for w, tree in trees.items():
        found = [dual_traversal(tree, tree, least)]
        if 2 * w in trees:
            wide = trees[2 * w]
            at = np.sort(wide.members)
            half = np.stack([maps[i][:w] | maps[i][w:] for i in at])
            found.append(dual_traversal(tree, SignatureTree(at, sizes[at], half), least))
        for x, y in found:
            left.append(np.minimum(x, y))
            right.append(np.maximum(x, y))
    return np.concatenate(left), np.concatenate(right)


class Groups:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent, self.left = list(range(n)), n

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        if i != j:
            self.parent[max(i, j)] = min(i, j)
            self.left -= 1


def verified(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, least: int, groups: Groups) -> None:
    """Compare possible pairs exactly, but for those that are connected by then."""
    by = np.lexsort((right, left))
    for i, j in zip(left[by].tolist(), right[by].tolist()):
        if groups.left == 1:
            return
        if groups.root(i) != groups.root(j) and linked(sets[i], sets[j], least):
            groups.join(i, j)


# -- the join ---------------------------------------------------------------

_FIRST = pa.schema([("kind", pa.int32()), ("doc", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("other", pa.int64()), ("same", pa.binary())])


def _frequent(counted: DataFrame) -> np.ndarray:
    """At most ``MAX_FREQUENT`` shingles, those found most often, as a sorted array."""
    total = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = counted.where(F.col("n") > max(64, total // MAX_FREQUENT)).select("doc").toArrow()
    return np.sort(found.column("doc").to_numpy().view(np.uint64))


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Null and empty texts have no shingles and link with nothing. Rows of one id
    are one document: a link of any of them is its link. A row without an id
    links with nothing and has no component. Further columns are not looked at.
    """
    if least < 50:
        raise ValueError("bitmap widths of linked sets are within one step only from 50 on")
    spark = docs.sparkSession
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc"), F.col(text_col).cast("string").alias("text"))

    def split(batch, frequent):
        """Sets of a slice; which stand for themselves, which for an equal set's earlier document."""
        values, offsets = shingle_sets(texts_of(batch), frequent)
        size = np.diff(offsets)
        known = batch.column("doc").is_valid().to_numpy(zero_copy_only=False)
        ids = batch.column("doc").fill_null(0).to_numpy()
        live = np.flatnonzero(known & (size > 0))
        leader = live[first_of_equal(values, offsets[live], offsets[live + 1], mix(values), ids[live])] if len(live) else live
        return values, offsets, size, ids, live, leader

    def first_pass(batches):
        for batch in slices(batches, limit=PACK_BYTES):
            values, offsets, size, ids, live, leader = split(batch, None)
            own = live[live == leader]
            maps = {i: bitmap(values[offsets[i] : offsets[i + 1]]).tobytes() for i in own.tolist()}
            sums = np.column_stack([sum_by(mix(values), offsets), sum_by(mix(values ^ _OTHER), offsets)])
            same = {i: sums[i].tobytes() for i in own.tolist()}
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.zeros(n, np.int32)), batch.column("doc"), pa.array(size), pa.array([maps.get(i) for i in range(n)], pa.binary()), pa.nulls(n, pa.int64()), pa.array([same.get(i) for i in range(n)], pa.binary())],
                schema=_FIRST,
            )
            copies = live[(live != leader) & (ids[live] != ids[leader])], leader[(live != leader) & (ids[live] != ids[leader])]
            n = len(copies[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, 1, np.int32)), pa.array(ids[copies[0]]), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(ids[copies[1]]), pa.nulls(n, pa.binary())],
                schema=_FIRST,
            )
            # Whole sets: where frequent keys move to the end, later shingles become keys.
            value, count = np.unique(values[_ragged(offsets[own], size[own])], return_counts=True)
            value, count = value[count > 1], count[count > 1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(value), 2, np.int32)), pa.array(value.view(np.int64)), pa.array(count), pa.nulls(len(value), pa.binary()), pa.nulls(len(value), pa.int64()), pa.nulls(len(value), pa.binary())],
                schema=_FIRST,
            )

    first = hand_off(narrow.mapInArrow(first_pass, "kind int, doc long, n long, bits binary, other long, same binary"), "kind")
    frequent = _frequent(first.where("kind = 2").groupBy("doc").agg(F.sum("n").alias("n")))
    keys = first.where("kind = 0").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] * (100 - least) // 100
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), keys // BUCKET_KEYS + 1)
    piece = pa.schema([("bucket", pa.int64()), ("data", pa.binary())])

    def to_keys(batches):
        for batch in slices(batches, limit=PACK_BYTES):
            values, offsets, size, ids, live, leader = split(batch, frequent)
            own = live[live == leader]
            take = prefix_length(size[own], least)
            at, doc = _ragged(offsets[own], take), np.repeat(np.arange(len(own)), take)
            value, place = values[at], at - offsets[own][doc]
            to = (mix(value) % np.uint64(buckets)).astype(np.int64)
            by = np.lexsort((value, to))
            value, place, doc, to = value[by], place[by], doc[by], to[by]
            edges = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
            out = [
                (int(to[lo]), pack(value[lo:hi], small(place[lo:hi]), *_local(doc[lo:hi], ids[own], size[own]), level=1))
                for lo, hi in zip(edges[:-1], edges[1:]) if lo < hi
            ]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), piece)], schema=piece)

    member = pa.schema([("center", pa.int64()), ("doc", pa.int64())])

    def to_stars(table):
        parts = [unpack(x) for x in table.column("data").to_pylist()]
        value = np.concatenate([p[0] for p in parts])
        place = np.concatenate([p[1] for p in parts]).astype(np.int64)
        doc = np.concatenate([p[3][p[2].astype(np.int64)] for p in parts])
        n = np.concatenate([p[4][p[2].astype(np.int64)] for p in parts]).astype(np.int64)
        by = np.lexsort((doc, n, value))
        value, place, doc, n = value[by], place[by], doc[by], n[by]
        keep = may_link(value, place, doc, n, least)
        value, doc = value[keep], doc[keep]
        head = np.flatnonzero(np.append(True, value[1:] != value[:-1])[: len(value)])
        smallest = np.minimum.reduceat(doc, head) if len(head) else doc
        center = np.repeat(smallest, np.diff(np.append(head, len(value))))
        pairs = np.unique(np.column_stack([center, doc])[center != doc], axis=0)
        # The same pair comes from many buckets: pairs meet once more, packed, by their own hash.
        to = (mix(pairs[:, 0].view(np.uint64) ^ mix(pairs[:, 1].view(np.uint64))) % np.uint64(buckets)).astype(np.int64)
        pairs, to = pairs[np.argsort(to, kind="stable")], np.sort(to)
        edges = np.concatenate([[0], np.flatnonzero(to[1:] != to[:-1]) + 1, [len(to)]])
        out = [(int(to[a]), pack(pairs[a:b, 0], pairs[a:b, 1])) for a, b in zip(edges[:-1], edges[1:]) if a < b]
        columns = zip(*out) if out else [(), ()]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, piece)], schema=piece)

    def distinct(table):
        parts = [unpack(x) for x in table.column("data").to_pylist()]
        pairs = np.unique(np.column_stack([np.concatenate([p[i] for p in parts]) for i in (0, 1)]), axis=0)
        return pa.Table.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=member)

    packed = narrow.mapInArrow(to_keys, "bucket long, data binary").groupBy("bucket").applyInArrow(to_stars, "bucket long, data binary")
    stars = hand_off(packed.groupBy("bucket").applyInArrow(distinct, "center long, doc long"))
    equal = _equal_sets(first.where("kind = 0"))
    stars = _by_representative(stars, equal)
    links = _star_links(narrow, first.where("kind = 0 AND bits IS NOT NULL"), stars, least)
    copies = first.where("kind = 1").select(F.col("other").alias("a"), F.col("doc").alias("b"))
    found = components(links.union(copies).union(equal.select("rep", "copy")))
    return (
        first.where("kind = 0").select(F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"))
        .join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    )


def _equal_sets(sized: DataFrame) -> DataFrame:
    """``copy, rep``: documents whose set (by a 128-bit sum and its size) a smaller id has too.

    Ids that stand on several rows may have several sets and stay out of this.
    """
    single = sized.groupBy("doc").agg(F.count(F.lit(1)).alias("rows"), F.max("same").alias("same"), F.max("n").alias("n"))
    single = single.where("rows = 1 AND same IS NOT NULL")
    reps = single.groupBy("same", "n").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("docs")).where("docs > 1")
    reps = reps.select(F.col("same").alias("s"), F.col("n").alias("m"), "rep")
    pairs = single.join(reps, (F.col("same") == F.col("s")) & (F.col("n") == F.col("m")))
    return hand_off(pairs.where("doc <> rep").select(F.col("doc").alias("copy"), "rep"))


def _by_representative(stars: DataFrame, equal: DataFrame) -> DataFrame:
    """Star rows with every document replaced by the first with the same set."""
    for side in ("center", "doc"):
        stars = stars.join(equal, F.col(side) == F.col("copy"), "left").withColumn(side, F.coalesce("rep", side)).drop("copy", "rep")
    return hand_off(stars.where("center <> doc").distinct())


def keep_representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` but those of documents linked to one with a smaller id: one of each group stays."""
    found = similar_documents(docs, id_col, text_col, least)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone.hint("merge"), F.col(id_col) == F.col("__gone"), "left_anti")


def _local(doc: np.ndarray, ids: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    used, local = np.unique(doc, return_inverse=True)
    return small(local), ids[used], small(size[used])


def _star_links(narrow: DataFrame, signatures: DataFrame, stars: DataFrame, least: int) -> DataFrame:
    """Links that connect the members of each star as far as they are similar."""
    sized = stars.groupBy(F.col("center").alias("c")).agg(F.ceil((F.count(F.lit(1)) + 1) / CHUNK).cast("int").alias("chunks"))
    placed = stars.join(sized, F.col("center") == F.col("c")).drop("c")
    chunk = F.pmod(F.xxhash64("doc"), F.col("chunks")).cast("int")
    # The centre is a member of every chunk of its star.
    own = sized.select(F.col("c").alias("center"), F.col("c").alias("doc"), "chunks", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    members = hand_off(placed.select("center", "doc", "chunks", chunk.alias("chunk")).union(own))
    groups = members.count() // GROUP_ROWS + 1
    star = lambda df: df.withColumn("g", F.pmod(F.xxhash64("center", "chunk"), F.lit(groups)))

    def likely(table):
        keep = np.zeros(table.num_rows, bool)
        n = table.column("n").to_numpy()
        bits = table.column("bits").to_pylist()
        for at in _stars_of(table):
            left, right = possible_pairs(n[at], [np.frombuffer(bits[i], np.uint64) for i in at], least)
            keep[at[left]] = keep[at[right]] = True
        kept = table.filter(pa.array(keep))
        return kept.select(["center", "chunk", "doc"])

    signed = members.where("chunks = 1").join(signatures.select("doc", "n", "bits"), "doc").select("center", "chunk", "doc", "n", "bits")
    few = star(signed).groupBy("g").applyInArrow(likely, "center long, chunk int, doc long")
    whole = lambda df: df.withColumn("home", F.lit(-1)).withColumn("visits", F.lit(False))
    many = members.where("chunks > 1").select("center", "chunk", "doc")
    schema = "center long, chunk int, doc long, root long"
    found = hand_off(_compared(narrow, hand_off(whole(few.select("center", "chunk", "doc").union(many))), star, least, schema))
    # Large stars only: what is not connected to the centre is compared with the other chunks too.
    large = sized.where("chunks > 1").select(F.col("c").alias("center"), "chunks")
    alone = hand_off(found.where("root <> center").join(large, "center").select("center", "chunk", "doc").distinct())
    links = found.where("root <> doc").select(F.col("root").alias("a"), F.col("doc").alias("b"))
    if alone.isEmpty():
        return links
    tiles = hand_off(_tiles(many.join(large, "center"), alone))
    groups = tiles.count() // GROUP_ROWS + 1
    tile = lambda df: df.withColumn("g", F.pmod(F.xxhash64("center", "chunk"), F.lit(groups)))

    def likely_across(table):
        keep = np.zeros(table.num_rows, bool)
        n, home, visits = (table.column(c).to_numpy() for c in ("n", "home", "visits"))
        bits = table.column("bits").to_pylist()
        for at in _stars_of(table):
            left, right = possible_pairs(n[at], [np.frombuffer(bits[i], np.uint64) for i in at], least)
            asked = _asked(home[at], visits[at], left, right)
            keep[at[left[asked]]] = keep[at[right[asked]]] = True
        return table.filter(pa.array(keep)).select(["center", "chunk", "doc", "home", "visits"])

    signed = tiles.join(signatures.select("doc", "n", "bits"), "doc").select("center", "chunk", "doc", "home", "visits", "n", "bits")
    near = tile(signed).groupBy("g").applyInArrow(likely_across, "center long, chunk int, doc long, home int, visits boolean")
    more = hand_off(_compared(narrow, hand_off(near.distinct()), tile, least, schema))
    return links.union(more.where("root <> doc").select("root", "doc"))


def _tiles(many: DataFrame, alone: DataFrame) -> DataFrame:
    """``center, chunk, doc, home, visits``: members of large stars for each pair of chunks to compare.

    ``chunk`` numbers the pair. Of each chunk it has the members of ``alone``, and
    all others (``visits`` is false) if the other chunk has such members.
    """
    keys = ["center", "chunk", "doc"]
    marked = many.join(alone.withColumn("visits", F.lit(True)), keys, "left").withColumn("visits", F.coalesce("visits", F.lit(False)))
    crossed = marked.withColumn("host", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).where("host <> chunk")
    asking = alone.select("center", F.col("chunk").alias("host")).distinct().withColumn("asks", F.lit(True))
    crossed = crossed.join(asking, ["center", "host"], "left").where("visits OR asks")
    pair = F.least("chunk", "host") * F.col("chunks") + F.greatest("chunk", "host")
    return crossed.select("center", pair.cast("int").alias("pair"), "doc", F.col("chunk").alias("home"), "visits").withColumnRenamed("pair", "chunk")


def _asked(home: np.ndarray, visits: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs are to be compared: all in a whole star, else those across chunks with a visiting member."""
    return (home[left] < 0) | ((home[left] != home[right]) & (visits[left] | visits[right]))


def _stars_of(table: pa.Table) -> list[np.ndarray]:
    """Row positions of each (center, chunk) with two members or more, by document."""
    center, chunk, doc = (table.column(c).to_numpy() for c in ("center", "chunk", "doc"))
    by = np.lexsort((doc, chunk, center))
    new = np.ones(len(by), bool)
    new[1:] = (center[by[1:]] != center[by[:-1]]) | (chunk[by[1:]] != chunk[by[:-1]])
    return [part for part in np.split(by, np.flatnonzero(new)[1:]) if len(part) > 1]


def _compared(narrow: DataFrame, members: DataFrame, star, least: int, schema: str) -> DataFrame:
    """Each member's smallest connected member in its chunk, from exact comparison.

    Between two chunks, only pairs across them with a visiting member are compared.
    """
    out = pa.schema([("center", pa.int64()), ("chunk", pa.int32()), ("doc", pa.int64()), ("root", pa.int64())])

    def compare(table):
        data = []
        for part in slices(table.select(["text"]).to_batches()):
            values, offsets = shingle_sets(texts_of(part))
            data += [values[a:b].copy() for a, b in zip(offsets[:-1], offsets[1:])]
        doc, home, visits = (table.column(c).to_numpy() for c in ("doc", "home", "visits"))
        root = doc.copy()
        for at in _stars_of(table):
            sets = [data[i] for i in at]
            left, right = possible_pairs(np.array([len(s) for s in sets]), [bitmap(s) for s in sets], least)
            asked = _asked(home[at], visits[at], left, right)
            left, right = left[asked], right[asked]
            connected = Groups(len(at))
            verified(sets, left, right, least, connected)
            root[at] = doc[at[[connected.root(i) for i in range(len(at))]]]
        columns = [table.column("center"), table.column("chunk"), table.column("doc"), pa.array(root)]
        return pa.Table.from_arrays(columns, schema=out)

    # Texts travel, not sets: compressed words take less than half of 8 bytes a shingle.
    texts = members.hint("merge").join(narrow, "doc").select("center", "chunk", "doc", "home", "visits", "text")
    return star(texts).groupBy("g").applyInArrow(compare, schema)
