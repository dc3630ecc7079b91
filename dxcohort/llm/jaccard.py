"""N-gram Jaccard join: a grouped prefix join, and the components of its links.

A document's set holds the hashes of its distinct shingles of ``k`` words (words
``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased; with fewer words the whole sequence is
the one shingle). Two documents link when 100 * |A & B| >= ``percent`` * |A | B|.
The query takes 3 words and 90; ``keep_one``, the near-duplicate stage of the
pipeline, 5 words and 80.

1. *Order.* A fixed-size table of counters over all shingles (``SLOTS``) puts
   rare shingles first. Any order gives right results; a good one keeps
   passages that many documents share out of the prefixes.
2. *Classes and groups.* Documents with equal sets form a class. Classes with
   the same size and the same prefix (the first |A| - ceil(percent |A| / 100) + 1
   shingles of the order) form a group; only groups are indexed.
3. *Group pairs.* Linked documents share a prefix shingle. Each group is first
   paired with one leader: of the groups that lead a shingle's bucket (fewest
   rarer shingles before it), the one it meets most often. Verified links give
   components, and only pairs of groups that are not yet in one component are
   listed afterwards, so a large group of near copies is never paired with
   itself. Size and position filters apply inside the join.
4. *Expand and verify.* Group pairs expand to their classes. A bound from
   hashed bucket counts (``BINS`` counters for each class) drops pairs that
   cannot reach the threshold, without loss; the rest are intersected.

Null or empty texts have an empty set, link with nothing and are their own
component. Rows are joined by content, so repeated rows or ids and null ids
need no special case (a component's id is its smallest non-null doc_id). Extra
columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dxcohort.llm.common import Words, arrow_text, runs, shingle_rows, ship, staged, worker_tables

PERCENT = 90
K = 3
STAGE_PERCENT = 80
STAGE_K = 5
#: Counters of the shingle order: 4 MB, whatever the input.
SLOTS = 1 << 20
#: Counters for each class in the overlap bound.
BINS = 128
#: Rows of ids up to which the side is broadcast (16 MB); beyond, it shuffles.
BROADCAST_IDS = 1_000_000
_PIECE = 4096


def least_size(percent: int) -> int:
    """Smaller sets can only link to equal sets."""
    return percent // (100 - percent)


def prefix_size(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def _needed(a: Column, b: Column, percent: int) -> Column:
    """Least common shingles of sets of these sizes, from i >= p (a + b - i)."""
    return F.ceil((a + b) * percent / F.lit(100.0 + percent) - 1e-9)


def _size_ok(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Each row's number and its sorted set of shingle hashes."""
    data, off = arrow_text(batch.column(batch.schema.get_field_index("text")))
    for a, b in runs(off):
        w = Words(data[off[a] : off[b]], off[a : b + 1] - off[a])
        for d, s in enumerate(shingle_rows(w, lower=True, k=k), a):
            yield d, np.unique(s)


def _class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def _slot(s: np.ndarray) -> np.ndarray:
    return (s >> np.uint64(44)).astype(np.int64)


def shingle_counts(docs: DataFrame, k: int = K) -> np.ndarray:
    """Counters over the shingles of all documents, by the top bits of the hash."""
    spark = docs.sparkSession

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("jaccard")
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            data, off = arrow_text(batch.column(0))
            for a, b in runs(off):
                rows = list(shingle_rows(Words(data[off[a] : off[b]], off[a : b + 1] - off[a]), lower=True, k=k))
                total += np.bincount(_slot(np.concatenate(rows)), minlength=SLOTS)
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        yield pa.RecordBatch.from_pydict({
            "piece": pa.array(range(SLOTS // _PIECE), pa.int32()),
            "counts": pa.array([total[i : i + _PIECE].tobytes() for i in range(0, SLOTS, _PIECE)], pa.binary()),
        })

    def add(pdf):
        total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in pdf["counts"])
        return pdf.head(1).assign(counts=[np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()])

    schema = "piece int, counts binary"
    tasks = 2 * spark.sparkContext.defaultParallelism  # tables of counters follow the cluster, not the input
    rows = docs.select(F.col("text").cast("string").alias("text")).coalesce(tasks).mapInArrow(count, schema).groupBy("piece").applyInPandas(add, schema).collect()
    out = np.zeros(SLOTS, np.uint32)
    for r in rows:
        out[r["piece"] * _PIECE : (r["piece"] + 1) * _PIECE] += np.frombuffer(r["counts"], np.uint32)
    return out


def _mark():
    """A hash of the text: with the doc_id it names a row, or rows that are equal."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def signatures(docs: DataFrame, counts: np.ndarray, k: int = K, percent: int = PERCENT, marked: bool = False) -> DataFrame:
    """doc_id, n, cid (class), gid (group), prefix (rarest first; empty for
    sets too small to link to any but their equals) and, if asked for, mark."""
    spark = docs.sparkSession
    order, least = spark.sparkContext.broadcast(counts), least_size(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_tables("jaccard")
        seen = order.value
        for batch in batches:
            n, cid, gid, prefix = [], [], [], []
            for _, s in _sets(batch, k):
                n.append(len(s))
                cid.append(_class_id(s))
                head = s[:0]
                if len(s) >= least:
                    rank = np.lexsort((s, seen[_slot(s)]))[: prefix_size(len(s), percent)]
                    head = s[rank]
                gid.append(_class_id(np.append(head, np.uint64(len(s)))) if len(head) else cid[-1])
                prefix.append(head.view(np.int64))
            out = {
                "doc_id": batch.column(0), "n": pa.array(n, pa.int32()), "cid": pa.array(cid, pa.int64()),
                "gid": pa.array(gid, pa.int64()), "prefix": pa.array(prefix, pa.list_(pa.int64())),
            }
            if marked:
                out["mark"] = batch.column(2)
            yield pa.RecordBatch.from_pydict(out)

    extra = [_mark().alias("mark")] if marked else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *extra)
    return rows.mapInArrow(sign, "doc_id long, n int, cid long, gid long, prefix array<long>" + (", mark long" if marked else ""))


def _class_sets(docs: DataFrame, reps: DataFrame, k: int) -> DataFrame:
    """cid, elements (sorted hashes) and bins of the classes whose
    representative documents ``reps`` (cid, low) names; made again from the
    texts, because the sets of all documents are larger than the input."""
    few = reps.count() <= BROADCAST_IDS
    side = F.broadcast(reps) if few else reps
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.join(side.select(F.col("low")).distinct(), F.col("doc_id").eqNullSafe(F.col("low")), "left_semi").select("text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cid, n, elements, bins = [], [], [], []
            for _, s in _sets(batch, k):
                if len(s):
                    cid.append(_class_id(s))
                    n.append(len(s))
                    elements.append(s.tobytes())
                    bins.append(np.minimum(np.bincount((s & np.uint64(BINS - 1)).astype(np.int64), minlength=BINS), 255).astype(np.uint8).tobytes())
            yield pa.RecordBatch.from_pydict({"cid": pa.array(cid, pa.int64()), "n": pa.array(n, pa.int32()), "elements": pa.array(elements, pa.binary()), "bins": pa.array(bins, pa.binary())})

    made = rows.mapInArrow(make, "cid long, n int, elements binary, bins binary")
    return made.join(reps.select("cid"), "cid", "left_semi").dropDuplicates(["cid"])


def _may_link(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs whose bucket counts allow enough common shingles."""
        for batch in batches:
            if not batch.num_rows:
                continue
            t = batch.to_pydict()
            a = np.frombuffer(b"".join(t["bins_a"]), np.uint8).reshape(-1, BINS)
            b = np.frombuffer(b"".join(t["bins_b"]), np.uint8).reshape(-1, BINS)
            na, nb = np.array(t["na"], np.int64), np.array(t["nb"], np.int64)
            common = np.minimum(a, b).astype(np.int64).sum(1)
            full = ((a == 255) | (b == 255)).any(1)  # a counter that may hold more proves nothing
            ok = full | (100 * common >= percent * (na + nb - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return check


def _verify(percent: int):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column("elements_a"), batch.column("elements_b"), strict=True):
                p, q = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                at = np.minimum(np.searchsorted(p, q), len(p) - 1)
                common = int((p[at] == q).sum())
                ok.append(100 * common >= percent * (len(p) + len(q) - common))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return check


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that link."""
    if not pairs.take(1):
        return pairs
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    sets = staged(_class_sets(docs, staged(classes.join(wanted, "cid", "left_semi").select("cid", "low"), "op3-reps"), k), "op3-sets")
    side = lambda col, s: sets.select(F.col("cid").alias(s), F.col("n").alias(f"n{s}"), F.col(col).alias(f"{col}_{s}"))
    rough = pairs.join(side("bins", "a"), "a").join(side("bins", "b"), "b").mapInArrow(_may_link(percent), "a long, b long")
    rough = staged(rough, "op3-rough")
    return staged(rough.join(side("elements", "a"), "a").join(side("elements", "b"), "b").mapInArrow(_verify(percent), "a long, b long"), "op3-links")


def components(edges: DataFrame) -> DataFrame:
    """node, root (smallest node reachable) for every node of ``edges`` (a, b):
    large-star and small-star steps until the edges are stars."""
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    mark = None
    while True:
        both = now.union(now.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        now = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = now.groupBy("u").agg(F.min("v").alias("m"))
        step = now.join(low, "u")
        now = step.select(F.col("v").alias("u"), F.col("m").alias("v")).union(step.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        now = staged(now, "cc")
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(new) == mark:
            break
        mark = tuple(new)
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())


def _labels(members: DataFrame, links: DataFrame) -> DataFrame:
    """members with ``root``: the component of each class by the links so far."""
    found = staged(components(links), "op3-roots")
    return members.join(found.withColumnRenamed("node", "cid"), "cid", "left").withColumn("root", F.coalesce("root", "cid"))


def class_roots(docs: DataFrame, k: int = K, percent: int = PERCENT, marked: bool = False) -> tuple[DataFrame, DataFrame]:
    """The signatures of the rows, and cid, low (smallest doc_id), root (its
    component) of every class."""
    ship(docs.sparkSession)
    least = least_size(percent)
    sig = staged(signatures(docs, shingle_counts(docs, k), k, percent, marked), "op3-sig")
    classes = staged(
        sig.where("n > 0").groupBy("cid", "n", "gid").agg(F.min("doc_id").alias("low"), F.first("prefix").alias("prefix")), "op3-classes"
    )
    members = classes.where(F.col("n") >= least).select("cid", "n", "gid", "low")
    groups = classes.where(F.col("n") >= least).groupBy("gid", "n").agg(F.min("cid").alias("head"), F.first("prefix").alias("prefix"))
    heads = staged(groups.select("gid", "n", "head"), "op3-heads")
    # Index rows are narrow: seat holds the place in the prefix, then the set's size.
    index = groups.select(F.posexplode("prefix").alias("pos", "token"), "gid", "n").select(
        "token", "gid", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("n")).alias("seat")
    )

    # Only shingles in the prefixes of two groups or more matter from here on.
    leaders = index.groupBy("token").agg(F.min(F.struct("seat", "gid")).alias("lead"), F.max("gid").alias("g1"), F.min("gid").alias("g0"))
    leaders = leaders.where("g0 < g1").select("token", "lead")
    place = lambda c, seat: [F.shiftright(seat, 32).cast("int").alias(f"pos{c}"), seat.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias(f"n{c}")]
    index = staged(index.join(leaders, "token"), "op3-index").select(
        "token", "gid", *place("", F.col("seat")), F.col("lead.gid").alias("lead"), *place("_lead", F.col("lead.seat"))
    )

    def fits(n: Column, pos: Column, m: Column, at: Column) -> Column:
        """Sizes and places of one shingle allow a link."""
        return _size_ok(n, m, percent) & (F.least(n - pos, m - at) >= _needed(n, m, percent))

    led = index.where("gid <> lead").where(fits(F.col("n"), F.col("pos"), F.col("n_lead"), F.col("pos_lead")))
    first = led.groupBy("gid", "lead").count().groupBy("gid").agg(F.max(F.struct("count", "lead")).alias("m")).select("gid", F.col("m.lead").alias("lead"))
    head = lambda g, c: heads.select(F.col("gid").alias(g), F.col("head").alias(c))
    first = first.join(head("gid", "a"), "gid").join(head("lead", "b"), "lead").select("a", "b")
    inside = members.join(head("gid", "b"), "gid").where("cid <> b").select(F.col("cid").alias("a"), "b")
    links = _links(docs, classes, staged(first.union(inside), "op3-first"), k, percent)

    # What is not yet in one component: all pairs of the buckets that pass the filters.
    labels = staged(_labels(members, links), "op3-labels")
    of_group = labels.groupBy("gid").agg(F.min("root").alias("r0"), F.max("root").alias("r1"))
    known = index.select("token", "gid", "n", "pos").join(of_group, "gid")
    open_tokens = known.groupBy("token").agg(F.min("r0").alias("lo"), F.max("r1").alias("hi")).where("lo < hi").select("token")
    left = staged(known.join(open_tokens, "token", "left_semi"), "op3-open")
    apart = (F.col("x.r0") != F.col("y.r0")) | (F.col("x.r0") != F.col("x.r1")) | (F.col("y.r0") != F.col("y.r1"))
    may = fits(F.col("x.n"), F.col("x.pos"), F.col("y.n"), F.col("y.pos"))
    met = left.alias("x").join(left.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.gid") < F.col("y.gid")) & apart & may)
    group_pairs = met.select(F.col("x.gid").alias("g"), F.col("y.gid").alias("h")).distinct()
    mixed = of_group.where("r0 < r1").select(F.col("gid").alias("g"), F.col("gid").alias("h"))
    side = lambda g, c: labels.select(F.col("gid").alias(g), F.col("cid").alias(c), F.col("root").alias(f"r{c}"))
    more = group_pairs.union(mixed).join(side("g", "a"), "g").join(side("h", "b"), "h").where("ra <> rb")
    more = staged(more.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "op3-more")
    extra = _links(docs, classes, more, k, percent)

    if extra is not more:
        labels = staged(_labels(members, links.union(extra)), "op3-labels")
    return sig, classes.join(labels.select("cid", "root"), "cid", "left").select("cid", "low", F.coalesce("root", "cid").alias("root"))


def jaccard_components(docs: DataFrame, k: int = K, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs``."""
    sig, roots = class_roots(docs, k, percent)
    lows = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    of_class = roots.join(lows, "root").select("cid", "component_id")
    return sig.select("doc_id", "n", "cid").join(of_class, "cid", "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def op3_ngram_jaccard_join(docs: DataFrame) -> DataFrame:
    return jaccard_components(docs)


def keep_one(docs: DataFrame, k: int = STAGE_K, percent: int = STAGE_PERCENT) -> DataFrame:
    """One row of each component, the one with the smallest id (null last; ties:
    the smallest hash of the text); rows without words are all kept. Rows are
    judged by their texts, so rows that share an id, or have none, stay apart
    unless their texts link them."""
    sig, roots = class_roots(docs, k, percent, marked=True)
    # A class, or a component, may hold a third of all rows: it is only ever
    # aggregated, and rows are joined by what names them.
    least = lambda c: F.min(c).alias("k")
    of_class = sig.where("n > 0").groupBy("cid").agg(least(F.struct(F.col("doc_id").isNull().alias("lost"), "doc_id", "mark")))
    keepers = of_class.join(roots.select("cid", "root"), "cid").groupBy("root").agg(least("k"))
    keepers = keepers.select(F.col("k.doc_id").alias("kept_id"), F.col("k.mark").alias("kept_mark"))
    rows = sig.where("n > 0").groupBy("doc_id", "mark").agg(F.count("*").alias("c"))
    stays = F.col("doc_id").eqNullSafe(F.col("kept_id")) & (F.col("mark") == F.col("kept_mark"))
    judged = rows.join(keepers, stays, "left").select("doc_id", "mark", "c", F.col("kept_mark").isNotNull().alias("stay"))
    judged = staged(judged, "op3-judged")
    names = {}
    for name in ("doc_id", "mark"):  # names that the documents do not have
        names[name] = f"_{name}"
        while names[name] in docs.columns:
            names[name] = "_" + names[name]
    leave, again = (judged.where(w).select(*[F.col(c).alias(n) for c, n in names.items()]) for w in ("not stay", "stay and c > 1"))
    if leave.count() <= BROADCAST_IDS:
        leave = F.broadcast(leave)
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(names["doc_id"])) & (_mark() == F.col(names["mark"]))
    out = docs.join(leave, same, "left_anti")
    if again.take(1):  # equal rows: one of them stays
        twice = out.join(again, same, "left_semi").withColumn(names["mark"], _mark())
        out = out.join(again, same, "left_anti").union(twice.dropDuplicates(["doc_id", names["mark"]]).drop(names["mark"]))
    return out


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, chr(10))
         ELSE ws[i] || chr(10) || ws[i + 1] || chr(10) || ws[i + 2] END AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 1, 2))) AS i FROM w WHERE len(ws) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, nx.n, ny.n HAVING 100 * count(*) >= 90 * (nx.n + ny.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id, n.n
"""
