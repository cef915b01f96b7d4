"""Near-duplicate classes by ProbMinHash, banding and exact verification.

A text's elements are its runs of five lower-cased words (a shorter text is one
element), weighted by how often they occur.  Every element is a Poisson process
whose rate is its weight: exponential gaps give its arrival times, each arrival
falls into a random register, and a register keeps the element that arrived
first.  An element stops when its next arrival is later than the latest entry
of all registers, so long texts need little more than one arrival an element.
Two registers agree with the probability Jaccard similarity of the texts,
J = sum over common d of 1 / sum over d' of max(x[d'] / x[d], y[d'] / y[d]).

1. One map pass gives each document a 128-bit key of its word sequence and
   ``bands`` hashes of ``rows`` registers each.  Documents of equal key are one
   node, named by its smallest doc_id.
2. Nodes that share a band hash are candidates.  Each is linked to the smallest
   node of the bucket, never to all others, and each distinct link is verified
   by the exact J of the shingle counts.  Connected components follow from the
   verified links.
3. In a bucket whose nodes are still in several components every node is
   verified against the bucket's centre (the node with the smallest share of
   shingles that no other open node holds), and nodes along their sizes: a few
   pairs a node.  What then still spans components is compared again: every node
   outside the bucket's largest component against the nodes of other components,
   but for pairs whose counts already rule out the threshold (``possible``); a
   pair is met in one bucket only.  No pair that could be a link goes unseen.  Dense groups just below the threshold
   stay quadratic in what the bounds leave.

With 24 bands of 5 registers a pair at J = 0.8 shares a band with probability
0.9999.  Buckets and links are aggregated before they are joined; joins on a
hot bucket or link are sort-merge joins that AQE may split.

Defined results: one row per document (doc_id, class_id): the smallest doc_id
of its class.  Texts without words (null, empty) are not alike: each is its own
class.  Ids are whole numbers.  Texts are hashed whole, whatever their length.
Rows with a null id take no part and have no row in the result.  Rows
that repeat an id are one document: any of its texts can link it.  If they stay
unlike it has one row per distinct class.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import materialize, saved
from quarry.llm.words import bounds, column, mix, sequence_hash, text_slices, words

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: links for each task of a round of components
LINKS = 100_000
_LOCAL_BITS = 14


def shingles(h, doc, n_docs: int, n: int = SHINGLE):
    """(shingle hash, document) of every run of n words, in text order."""
    where = bounds(doc, n_docs)
    size = np.diff(where)
    s = sequence_hash(h, n)
    whole = np.flatnonzero(doc[:len(s)] == doc[n - 1:]) if len(s) else np.zeros(0, np.int64)
    out, owner = [s[whole]], [doc[whole]]
    for k in range(1, n):
        short = np.flatnonzero(size == k)
        if len(short):
            out.append(sequence_hash(h, k)[where[short]])
            owner.append(short)
    return np.concatenate(out), np.concatenate(owner)


def signatures(element, weight, doc, n_docs: int, registers: int):
    """ProbMinHash registers (n_docs x registers) of weighted elements; documents
    without an element keep zeros."""
    first = np.full(n_docs * registers, np.inf)
    sig = np.zeros(n_docs * registers, np.uint64)
    e, w, d = element, weight.astype(np.float64), doc.astype(np.int64)
    t = np.zeros(len(e))
    step = 0
    while len(e):
        step += 1
        r = mix(e + np.uint64((step * 0xD1342543DE82EF95) % 2 ** 64))
        t = t - np.log(((r >> np.uint64(12)).astype(np.float64) + 1) * 2.0 ** -52) / w
        cell = d * registers + (mix(r) % np.uint64(registers)).astype(np.int64)
        early = np.flatnonzero(t < first[cell])
        np.minimum.at(first, cell[early], t[early])
        win = early[t[early] == first[cell[early]]]
        sig[cell[win]] = e[win]
        go = t < first.reshape(n_docs, registers).max(axis=1)[d]
        e, w, d, t = e[go], w[go], d[go], t[go]
    return sig.reshape(n_docs, registers)


def _hash_documents(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = column(batch, "doc_id")
            for a, b, data, offs in text_slices(column(batch, "text")):
                for lo in range(0, b - a, 1 << _LOCAL_BITS):  # the sort key below holds the row in its top bits
                    hi = min(b - a, lo + (1 << _LOCAL_BITS))
                    yield _keys(ids.slice(a + lo, hi - lo), data[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo],
                                bands, rows)
    return run


def _keys(ids, data, offs, bands: int, rows: int) -> pa.RecordBatch:
    n = len(offs) - 1
    h, doc, _, _ = words(data, offs)
    where = bounds(doc, n)
    local = np.arange(len(h)) - where[doc]
    key = [np.zeros(n, np.uint64), np.zeros(n, np.uint64)]
    full = np.flatnonzero(np.diff(where) > 0)
    if len(full):
        for k, salt in enumerate((0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179)):
            key[k][full] = mix(np.add.reduceat(mix((h ^ np.uint64(salt)) + mix(local.astype(np.uint64))), where[full]))
    s, owner = shingles(h, doc, n)
    packed = (owner.astype(np.uint64) << np.uint64(64 - _LOCAL_BITS)) | (s >> np.uint64(_LOCAL_BITS))
    packed, count = np.unique(packed, return_counts=True)
    element = mix(packed & np.uint64(2 ** (64 - _LOCAL_BITS) - 1))
    sig = signatures(element, count, packed >> np.uint64(64 - _LOCAL_BITS), n, bands * rows)
    band = np.zeros((n, bands), np.uint64)
    for j in range(rows):
        band = mix(band + sig[:, j::rows] * np.uint64(0x9E3779B97F4A7C15) + np.uint64(j + 1))
    band = mix(band + np.arange(bands, dtype=np.uint64))
    flat = pa.array(band.view(np.int64).ravel())
    cuts = np.append(np.zeros(1, np.int64), np.cumsum(np.where(np.diff(where) > 0, bands, 0))).astype(np.int32)
    flat = flat.filter(pa.array(np.repeat(np.diff(where) > 0, bands)))
    plain = np.ones(n, bool)
    plain[(packed[count > 1] >> np.uint64(64 - _LOCAL_BITS)).astype(np.int64)] = False
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(key[0].view(np.int64)), pa.array(key[1].view(np.int64)),
         pa.ListArray.from_arrays(pa.array(cuts), flat), pa.array(np.bincount(owner, minlength=n)), pa.array(plain)],
        names=["doc_id", "k1", "k2", "bands", "total", "plain"])


def similarity(a_hash, a_count, b_hash, b_count) -> tuple[float, int]:
    """Exact probability Jaccard of two weighted sets given as sorted hashes and
    counts, and how many elements are common."""
    common, ia, ib = np.intersect1d(a_hash, b_hash, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0, 0
    x, y = a_count[ia].astype(float), b_count[ib].astype(float)
    only_a = a_count.sum() - x.sum()
    only_b = b_count.sum() - y.sum()
    total = 0.0
    for ratio in np.unique(x / y):
        # for elements with x / y = ratio, J adds x / sum max(x', ratio y')
        at = x / y == ratio
        total += x[at].sum() / (np.maximum(x, ratio * y).sum() + only_a + ratio * only_b)
    return float(total), len(common)


def _shingle_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, sorted shingle hashes, counts) as binary arrays."""
    for batch in batches:
        ids = column(batch, "doc_id")
        for a, b, data, offs in text_slices(column(batch, "text")):
            h, doc, _, _ = words(data, offs)
            s, owner = shingles(h, doc, b - a)
            order = np.argsort(owner, kind="stable")
            s, where = s[order], bounds(owner[order], b - a)
            sets, counts = [], []
            for d in range(b - a):
                v, c = np.unique(s[where[d]:where[d + 1]], return_counts=True)
                sets.append(v.tobytes())
                counts.append(c.astype(np.uint32).tobytes())
            yield pa.RecordBatch.from_pydict({"doc_id": ids.slice(a, b - a), "s": pa.array(sets, pa.binary()),
                                              "c": pa.array(counts, pa.binary())})


def _verify(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, common = [], []
            for sa, ca, sb, cb in zip(*(column(batch, c) for c in ("sa", "ca", "sb", "cb"))):
                a, b = np.frombuffer(sa.as_buffer(), np.uint64), np.frombuffer(sb.as_buffer(), np.uint64)
                j, c = similarity(a, np.frombuffer(ca.as_buffer(), np.uint32), b, np.frombuffer(cb.as_buffer(), np.uint32))
                keep.append(j if j >= threshold - 1e-12 else None)
                common.append(c)
            got = pa.array(keep, pa.float64())
            out = pa.RecordBatch.from_arrays([column(batch, "a"), column(batch, "b"), got, pa.array(common, pa.int64())],
                                             names=["a", "b", "j", "common"])
            yield out.filter(got.is_valid())
    return run


def shingle_sets(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(doc_id, s, c) of the texts of ``nodes`` (doc_id): the one shuffle of whole texts."""
    return materialize(texts.join(nodes, "doc_id", "left_semi").select("doc_id", "text")
                       .mapInArrow(_shingle_sets, "doc_id long, s binary, c binary"), "shingle-sets")


def verify(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The (a, b, j, common) of ``pairs`` (a, b) whose texts have J >= threshold."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa"), F.col("c").alias("ca"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb"), F.col("c").alias("cb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "sa", "ca", "sb", "cb")
            .mapInArrow(_verify(threshold), "a long, b long, j double, common long"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (a, b): root is the smallest node of
    its connected component.  Alternates large-star and small-star steps: each
    round hangs neighbours below the smallest node seen, until nothing moves."""
    # few links need few tasks and files: a task for every ``LINKS`` of them
    parts = max(1, -(-links.count() // LINKS))
    edges = saved(links.select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u"))
                  .where("v <> u").coalesce(parts).distinct().coalesce(parts))
    state = None
    while True:
        both = edges.select("v", "u").unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).select("v", F.least("v", "m").alias("m"))
        large = (both.where("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
                 .where("v <> u").coalesce(parts).distinct().coalesce(parts))
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        small = large.join(low, "v").select(F.when(F.col("u") == F.col("m"), F.col("v")).otherwise(F.col("u")).alias("v"),
                                            F.col("m").alias("u")).where("v <> u").coalesce(parts).distinct()
        edges = saved(small.coalesce(parts))
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("v", "u").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    return edges.groupBy("v").agg(F.min("u").alias("root")).select(F.col("v").alias("node"), "root").unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def _shingle_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shingle hash, node, count) of every entry of the sets, a document at a time."""
    for batch in batches:
        for node, s, c in zip(*(column(batch, k) for k in ("doc_id", "s", "c"))):
            v = np.frombuffer(s.as_buffer(), np.int64)
            n = np.frombuffer(c.as_buffer(), np.uint32).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v), pa.array(np.full(len(v), node.as_py())), pa.array(n)], names=["s", "node", "n"])


def profiles(sets: DataFrame, hashed: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, total, alone, plain) of ``nodes``: how many shingles its text has, how
    many of these no other of the texts holds, and whether all are different.  Ids
    with several texts get alone = 0 and plain = false, which rules nothing out."""
    own = (sets.join(nodes, sets["doc_id"] == nodes["node"], "left_semi")
           .mapInArrow(_shingle_rows, "s long, node long, n long")
           .groupBy("s").agg(F.count("*").alias("holders"), F.min("node").alias("node"), F.min("n").alias("n"))
           .where("holders = 1").groupBy("node").agg(F.sum("n").alias("alone")))
    size = (hashed.join(nodes, hashed["doc_id"] == nodes["node"], "left_semi").groupBy(F.col("doc_id").alias("node"))
            .agg(F.count("*").alias("texts"), F.max("total").alias("total"), F.min("plain").alias("plain")))
    one = F.col("texts") == 1
    return size.join(own, "node", "left").select(
        "node", "total", F.when(one, F.coalesce("alone", F.lit(0))).otherwise(0).alias("alone"),
        (F.col("plain") & one).alias("plain"))


def possible(x: str, y: str, threshold: float):
    """Whether the texts of profiles ``x`` and ``y`` can have J >= threshold.

    With shares u and v of lone weight, J <= (1 - u)(1 - v) / (1 - uv): in
    normalised weights p, q a common element adds at most p q / (u q + p), which
    is concave, and the common weights are at most 1 - u and 1 - v.

    If no text repeats a shingle, J is that of sets: with s common elements of n
    and m, J = s / (n + m - s).  s is at most the smaller rest without lone
    shingles.  And of the ``common`` elements that each has with a third text, the
    bucket's centre, no more than the smaller number are in both; elsewhere no
    more than the smaller number of shingles that are not lone.
    """
    least = threshold - 1e-9
    n, m, a, b = (F.col(f"{p}.{f}") for f in ("total", "alone") for p in (x, y))
    cn, cm = F.col(f"{x}.common"), F.col(f"{y}.common")
    u, v = a / n, b / m
    by_centre = F.least(cn, cm) + F.greatest(F.least(n - cn - a, m - cm - b), F.lit(0))
    s = F.least(n - a, m - b, by_centre)  # a null by_centre does not count
    return (((1 - u) * (1 - v) >= least * (1 - u * v))
            & (~(F.col(f"{x}.plain") & F.col(f"{y}.plain")) | (s >= least * (n + m - s))))


def open_buckets(member: DataFrame, root: DataFrame) -> DataFrame:
    """(b, node, root, main) of the buckets whose nodes lie in several components;
    ``main`` is the component with most of them."""
    placed = member.select("b", "node").join(root, "node", "left").select(
        "b", "node", F.coalesce("root", "node").alias("root"))
    sized = placed.groupBy("b", "root").agg(F.count("*").alias("n"))
    split = sized.groupBy("b").agg(F.max(F.struct("n", "root")).alias("top"), F.count("*").alias("k")).where("k > 1")
    return placed.join(split.select("b", F.col("top.root").alias("main")), "b")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS,
                    rows: int = ROWS) -> DataFrame:
    """(doc_id, class_id, class_size) for every document with an id."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    hashed = materialize(docs.mapInArrow(_hash_documents(bands, rows),
                                         "doc_id long, k1 long, k2 long, bands array<long>, total long, plain boolean"), "minhash")
    full = hashed.where(F.size("bands") > 0)
    node = saved(full.groupBy("k1", "k2").agg(F.min("doc_id").alias("node"))
                 .select(F.col("k1").alias("n1"), F.col("k2").alias("n2"), "node"))
    own = (F.col("k1") == F.col("n1")) & (F.col("k2") == F.col("n2"))
    buckets = full.join(node, own & (F.col("doc_id") == F.col("node")), "left_semi").select(
        F.explode("bands").alias("b"), F.col("doc_id").alias("node"))
    low = buckets.groupBy("b").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1")
    member = materialize(buckets.join(low, "b").select("b", "node", "low"), "buckets")
    pairs = saved(member.where("node <> low").select(F.col("low").alias("a"), F.col("node").alias("b")).distinct())
    sets = shingle_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    links = saved(verify(pairs, sets, threshold).select("a", "b"))
    root = saved(components(links))

    # buckets that still span components: first to their centre and along sizes, then all that is left
    spread = saved(open_buckets(member, root).select("b", "node"))
    profile = saved(profiles(sets, hashed, spread.select("node").distinct()))
    spread = saved(spread.join(profile, "node").where(F.col("alone") <= (1 - threshold + 1e-9) * F.col("total")))
    centre = spread.groupBy("b").agg(F.min(F.struct(
        (F.col("alone") / F.col("total")).alias("share"), "node", "plain")).alias("c"))
    spread = spread.join(centre.select("b", F.col("c.node").alias("centre"), F.col("c.plain").alias("whole")), "b")
    step = spread.groupBy("b", "total").agg(F.min("node").alias("first"))
    chain = step.select(F.col("first").alias("x"),
                        F.lag("first").over(Window.partitionBy("b").orderBy("total")).alias("y"))
    to_first = spread.join(step, ["b", "total"]).select(F.col("node").alias("x"), F.col("first").alias("y"))
    near = (spread.select(F.col("node").alias("x"), F.col("centre").alias("y")).unionByName(to_first)
            .unionByName(chain).where("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    seen = saved(verify(saved(near), sets, 0.0))
    links = saved(links.unionByName(seen.where(F.col("j") >= threshold - 1e-12).select("a", "b")))
    root = saved(components(links))

    far = seen.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("centre")),
                                        F.struct(F.col("b").alias("node"), F.col("a").alias("centre")))).alias("k"),
                      "common").select("k.*", "common")
    common = F.when(F.col("whole"), F.when(F.col("node") == F.col("centre"), F.col("total")).otherwise(F.col("common")))
    shape = spread.join(far, ["node", "centre"], "left").select(
        "b", "node", F.struct("total", "alone", "plain", common.alias("common")).alias("shape"))
    open_ = saved(open_buckets(spread.select("b", "node"), root).join(shape, ["b", "node"]))
    # a pair is met in the first bucket that it shares; the bounds of any one bucket hold
    mine = open_.groupBy("node").agg(F.collect_set("b").alias("bs"))
    open_ = open_.join(mine, "node")
    other = open_.select("b", F.col("node").alias("y"), F.col("root").alias("ry"), F.col("main").alias("m2"),
                         F.col("shape").alias("sy"), F.col("bs").alias("by"))
    rest = (open_.where("root <> main").select("b", F.col("node").alias("x"), F.col("root").alias("rx"),
                                               F.col("shape").alias("sx"), F.col("bs").alias("bx"))
            .join(other, "b").where("rx <> ry AND (ry = m2 OR x < y)").where(possible("sx", "sy", threshold))
            .where(F.array_min(F.array_intersect("bx", "by")) == F.col("b"))
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
            .join(pairs.unionByName(seen.select("a", "b")), ["a", "b"], "left_anti"))
    more = saved(verify(saved(rest), sets, threshold).select("a", "b"))
    root = components(links.unionByName(more))

    classes = (full.join(node, own).select("doc_id", "node")
               .join(root, "node", "left").select("doc_id", F.coalesce("root", "node").alias("class_id")))
    lone = hashed.where(F.size("bands") == 0).select("doc_id", F.col("doc_id").alias("class_id"))
    out = saved(classes.unionByName(lone).distinct())
    size = out.groupBy("class_id").agg(F.count("*").alias("class_size"))
    return out.join(size, "class_id").select("doc_id", "class_id", "class_size")


#: a name of its own, so that no column of the documents clashes with it
FREE = "quarry copy of a smaller id"


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, but for those of documents that are near
    copies of a document with a smaller id.  Rows with a null id stay."""
    gone = near_duplicates(docs, threshold).groupBy("doc_id").agg(F.min("class_id").alias("c")).where(
        "c <> doc_id").select(F.struct(F.col("doc_id").alias("id")).alias(FREE))
    return docs.join(gone, docs["doc_id"] == gone[FREE]["id"], "left_anti")
