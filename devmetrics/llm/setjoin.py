"""Exact join of documents whose word 5-gram sets are similar, with set-relation skipping.

Two documents link when the Jaccard similarity of their shingle sets is at
least ``percent`` / 100. The result is one row per document with the component
it reaches by links.

Equal sets are one node. Nodes meet in inverted lists over prefixes: sets in one
global order of shingles can only be similar if their prefixes share a shingle.
The order puts frequent shingles last, so that text which many unrelated
documents share brings none of them together. Frequent ones are the
``HEAVY_TOKENS`` most frequent that more than ``HEAVY`` nodes have in a prefix
by hash; any choice gives the same result.

Skipping within a list: entries are in order of set size and carry the position
of the shingle in their set. An entry only meets the block of sizes that the
similarity bound and its own position allow; with a position far back this
block is empty and the entry is passed over.

Skipping between sets: in a long list all entries are first compared with a
few leaders. Sets that link to a leader take over its component as their
answer. Only what is still in different components after that is compared
pair by pair, with the same block bounds and the outlines of both sets, which
bound their difference from below. No link between components can be missed:
each pair is verified, excluded by a bound, or already connected.

Every candidate is verified over the whole sets of both texts. Shingles and
sets are compared by 64-bit hashes (sets with their size too).

Defined cases: a document with fewer words than a shingle has its whole
sequence as one shingle; without words or text it has none and links to
nothing. Equal rows are documents of their own. A null id takes part but is
never a component's smallest id, unless there is no other. An empty table gives
an empty result. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from devmetrics.llm.bits import Bits
from devmetrics.llm.staging import Workspace, importable
from devmetrics.llm.wordhash import Batch, mixed, runs

SHINGLE = 5
PERCENT = 80

# A prefix shingle of more nodes than this counts as frequent ...
HEAVY = 8
# ... if it is among so many most frequent ones. They are sent to every task: 2 MB at most.
HEAVY_TOKENS = 1 << 18

# Lists up to this length are compared pair by pair at once.
SHORT_LIST = 8
LEADERS = 2

_PORTION = 1 << 20


def least_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection of similar sets of sizes ``a`` and ``b``."""
    return -(-percent * (a + b) // (100 + percent))


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


class Sets:
    """Distinct shingles of the texts of an Arrow array: ``token`` in order of ``text`` and hash."""

    def __init__(self, texts: pa.Array, size: int):
        batch = Batch(texts, lower=True)
        counts = batch.counts
        tokens, owners = [], []
        for k in range(1, size + 1):
            h, text = runs(batch.hash, batch.first, k)
            if k < size:
                whole = np.flatnonzero(counts == k)
                h, text = mixed(h[batch.first[whole]] + np.uint64(k)), whole
            else:
                inside = text >= 0
                h, text = h[inside], text[inside]
            tokens.append(h)
            owners.append(text)
        token, text = np.concatenate(tokens), np.concatenate(owners)
        order = np.lexsort((token, text))
        token, text = token[order], text[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (text[1:] != text[:-1])
        self.token, self.text = token[new], text[new]
        self.n = np.bincount(self.text, minlength=len(texts)).astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(self.n)])

    def fingerprints(self) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(self.token + np.uint64(11)), dtype=np.uint64)])
        return mixed(total[self.first[1:]] - total[self.first[:-1]]).astype(np.int64)

    def prefix(self, percent: int, heavy: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token, text, position) of the prefixes, frequent shingles last."""
        token, text = self.token, self.text
        if heavy is not None and len(heavy):
            at = np.minimum(np.searchsorted(heavy, token), len(heavy) - 1)
            order = np.lexsort((heavy[at] == token, text))
            token, text = token[order], text[order]
        position = np.arange(len(token)) - self.first[text]
        pick = position < prefix_length(self.n, percent)[text]
        return token[pick], text[pick], position[pick]


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    lengths = texts.fill_null("").cast(pa.large_string())
    sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1])
    total, start = np.concatenate([[0], np.cumsum(sizes)]), 0
    while start < len(texts):
        stop = int(np.searchsorted(total, total[start] + 4 * _PORTION, "right")) - 1
        stop = min(max(stop, start + 1), len(texts))
        yield start, stop
        start = stop


def _profiles(size: int, percent: int):
    """Size and fingerprint of each document, and the prefix of each set that the task meets first."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("tag", pa.int64()), ("n", pa.int32()), ("nid", pa.int64()), ("prefix", pa.list_(pa.int64()))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = _Met()
        for table in batches:
            for a, b in _slices(table.column(2)):
                part = table.slice(a, b - a)
                sets = Sets(part.column(2), size)
                nid = sets.fingerprints()
                fresh = met.fresh(sets.n, nid)
                token, text, _ = sets.prefix(percent)
                token = token[fresh[text]]
                lengths = np.bincount(text[fresh[text]], minlength=len(nid))
                offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(token.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(sets.n.astype(np.int32)), pa.array(nid), lists], schema=schema
                )

    return run


class _Met:
    """Which sets a task has met; forgets when it has met a million."""

    def __init__(self):
        self.seen: set[tuple[int, int]] = set()

    def fresh(self, n: np.ndarray, nid: np.ndarray) -> np.ndarray:
        if len(self.seen) > 1_000_000:
            self.seen.clear()
        out = np.zeros(len(n), bool)
        for i, key in enumerate(zip(n.tolist(), nid.tolist())):
            if key[0] and key not in self.seen:
                self.seen.add(key)
                out[i] = True
        return out


def _postings(size: int, percent: int, heavy):
    schema = pa.schema([("token", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("nid", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met, last = _Met(), heavy.value
        for table in batches:
            for a, b in _slices(table.column(0)):
                sets = Sets(table.column(0).slice(a, b - a), size)
                nid = sets.fingerprints()
                fresh = met.fresh(sets.n, nid)
                token, text, position = sets.prefix(percent, last)
                pick = fresh[text]
                token, text, position = token[pick], text[pick], position[pick]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token.astype(np.int64)), pa.array(sets.n[text].astype(np.int32)),
                        pa.array(position.astype(np.int32)), pa.array(nid[text]),
                    ],
                    schema=schema,
                )

    return run


_EDGES = pa.schema([
    ("token", pa.int64()), ("n", pa.int32()), ("pos", pa.int32()), ("nid", pa.int64()),
    ("n2", pa.int32()), ("nid2", pa.int64()),
])
_EDGE_DDL = "token bigint, n int, pos int, nid bigint, n2 int, nid2 bigint"


def _allowed(n, pos, n2, pos2, percent):
    """Whether sets can be similar whose first common shingle is this one."""
    need = least_overlap(n, n2, percent)
    return (np.minimum(n, n2) * 100 >= percent * np.maximum(n, n2)) & (np.minimum(n - pos, n2 - pos2) >= need)


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups of whole lists out of rows in order of the first column, as arrays."""
    kept: list[np.ndarray] | None = None
    for table in batches:
        columns = [table.column(i).to_numpy() for i in range(table.num_columns)]
        if kept is not None:
            columns = [np.concatenate(x) for x in zip(kept, columns)]
        if not len(columns[0]):
            continue
        cut = int(np.flatnonzero(columns[0] == columns[0][-1])[0])
        if cut:
            yield tuple(c[:cut] for c in columns)
        kept = [c[cut:] for c in columns]
    if kept is not None and len(kept[0]):
        yield tuple(kept)


def _bounds(token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
    return start, np.diff(np.append(start, len(token)))


def _edge_rows(token, n, nid, i, j) -> pa.RecordBatch:
    """Edges between entries ``i`` and ``j``; the smaller node first."""
    swap = (n[j] < n[i]) | ((n[j] == n[i]) & (nid[j] < nid[i]))
    a, b = np.where(swap, j, i), np.where(swap, i, j)
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays(
        [
            none, pa.array(n[a].astype(np.int32)), pa.nulls(len(a), pa.int32()), pa.array(nid[a]),
            pa.array(n[b].astype(np.int32)), pa.array(nid[b]),
        ],
        schema=_EDGES,
    )


def _first_round(percent: int):
    """Candidates of short lists pair by pair, of long ones with their leaders; and the long lists themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, n, pos, nid in _lists(batches):
            # Copies of a set from several tasks are neighbours.
            once = np.concatenate([[True], (token[1:] != token[:-1]) | (n[1:] != n[:-1]) | (nid[1:] != nid[:-1])])
            token, n, pos, nid = (x[once] for x in (token, n.astype(np.int64), pos.astype(np.int64), nid))
            start, length = _bounds(token)
            for gap in range(1, SHORT_LIST):
                i = np.flatnonzero(token[gap:] == token[:-gap]) if gap < len(token) else np.empty(0, np.int64)
                short = np.repeat(length <= SHORT_LIST, length)
                i = i[short[i]]
                i = i[_allowed(n[i], pos[i], n[i + gap], pos[i + gap], percent)]
                if len(i):
                    yield _edge_rows(token, n, nid, i, i + gap)
            for s, k in zip(start[length > SHORT_LIST], length[length > SHORT_LIST]):
                leaders = s + np.argsort(pos[s : s + k], kind="stable")[:LEADERS]
                for leader in leaders:
                    j = np.arange(s, s + k)
                    i = np.full(k, leader)
                    ok = (j != leader) & _allowed(n[i], pos[i], n[j], pos[j], percent)
                    if ok.any():
                        yield _edge_rows(token, n, nid, i[ok], j[ok])
                long = slice(s, s + k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(token[long]), pa.array(n[long].astype(np.int32)), pa.array(pos[long].astype(np.int32)),
                        pa.array(nid[long]), pa.nulls(k, pa.int32()), pa.nulls(k, pa.int64()),
                    ],
                    schema=_EDGES,
                )

    return run


def _outlines(size: int):
    """The outline of each set: one bit per hash value, set if an odd number of shingles has it.

    Two sets differ in at least as many shingles as their outlines in bits.
    """
    names = ["n", "nid", *_OUTLINE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            for a, b in _slices(table.column(2)):
                part = table.slice(a, b - a)
                sets = Sets(part.column(2), size)
                place = (sets.token % np.uint64(64 * len(_OUTLINE))).astype(np.int64)
                odd = np.zeros((b - a) * 64 * len(_OUTLINE), np.uint8)
                at, times = np.unique(sets.text * 64 * len(_OUTLINE) + place, return_counts=True)
                odd[at] = times & 1
                words = np.packbits(odd.reshape(b - a, -1), axis=1).view(np.int64)
                columns = [pa.array(np.ascontiguousarray(words[:, k])) for k in range(len(_OUTLINE))]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=names)

    return run


_OUTLINE = [f"b{k}" for k in range(8)]


def _second_round(percent: int):
    """Candidates between different components of long lists; in: token, n, pos, nid, component, outline."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, n, pos, nid, part, *outline in _lists(batches):
            n, pos = n.astype(np.int64), pos.astype(np.int64)
            drawn = np.stack(outline, axis=1).view(np.uint64)
            for s, k in zip(*_bounds(token)):
                size, place, who, group, shape = (x[s : s + k] for x in (n, pos, nid, part, drawn))
                names, members = np.unique(group, return_counts=True)
                if len(names) == 1:
                    continue
                main = names[np.argmax(members)]
                outside = np.flatnonzero(group != main)
                # The sizes that an entry may meet: from the similarity bound, and from its own position.
                low = -(-percent * size[outside] // 100)
                high = np.minimum(
                    size[outside] * 100 // percent,
                    (size[outside] - place[outside]) * (100 + percent) // percent - size[outside],
                )
                left = np.searchsorted(size, low, "left")
                right = np.searchsorted(size, high, "right")
                for v, a, b in zip(outside.tolist(), left.tolist(), right.tolist()):
                    if a >= b:
                        continue
                    j = np.arange(a, b)
                    i = np.full(len(j), v)
                    fresh = (group[j] == main) | (j < v)
                    ok = fresh & (group[j] != group[v]) & _allowed(size[i], place[i], size[j], place[j], percent)
                    i, j = i[ok], j[ok]
                    apart = np.bitwise_count(shape[j] ^ shape[v]).sum(axis=1)
                    near = apart <= size[i] + size[j] - 2 * least_overlap(size[i], size[j], percent)
                    if near.any():
                        yield _edge_rows(token, size, who, i[near], j[near])

    return run


def _verified(size: int, percent: int):
    schema = pa.schema([("n", pa.int32()), ("nid", pa.int64()), ("n2", pa.int32()), ("nid2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in batches:
            done = 0
            for a, b in _slices(table.column(4)):
                part = table.slice(a, b - a)
                x, y = Sets(part.column(4), size), Sets(part.column(5), size)
                token = np.concatenate([x.token, y.token])
                row = np.concatenate([x.text, y.text])
                order = np.lexsort((token, row))
                token, row = token[order], row[order]
                same = (token[1:] == token[:-1]) & (row[1:] == row[:-1])
                common = np.bincount(row[1:][same], minlength=b - a)
                linked = 100 * common >= percent * (x.n + y.n - common)
                done = b
                yield pa.RecordBatch.from_arrays(
                    [part.column(i).filter(pa.array(linked)) for i in range(4)], schema=schema
                )
            assert done == table.num_rows

    return run


def components(edges: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (u, v); the component is its smallest node.

    Large and small stars in turn: every node links its larger neighbours to the
    smallest one around it, then its smaller ones, until only stars are left. Both
    are grouped minima and joins.
    """

    def is_final(df: DataFrame) -> bool:
        """Whether these are stars: nodes with one edge each to a centre that has none itself."""
        ends = df.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.unionByName(df.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
        return ends.filter("up > 1 OR (up > 0 AND down > 0)").isEmpty()

    def near(df: DataFrame) -> DataFrame:
        return df.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))

    def distinct(df: DataFrame) -> DataFrame:
        return df.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    now = work.write(distinct(edges), f"{name}-0")
    step = 0
    while not is_final(now):
        step += 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(near(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = distinct(large)
        small = large.join(near(large), "u")
        small = small.select("v", "m").toDF("u", "v").unionByName(small.select("u", "m").toDF("u", "v"))
        now = work.write(distinct(small), f"{name}-{step}")
        work.drop(f"{name}-{step - 1}")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return work.write(stars.unionByName(centres), name)


def _node(n: str = "n", nid: str = "nid"):
    return F.struct(F.col(n).alias("n"), F.col(nid).alias("nid"))


def _key(doc_id: str = "doc_id"):
    """The id as a join key that is never null."""
    return F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63)))


def links(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT, shingle: int = SHINGLE
) -> DataFrame:
    """Per document: doc_id, tag (64 bits of its text), n_shingles, component_id, component.

    ``component`` tells components apart where ids repeat; it is null without shingles.
    """
    spark = docs.sparkSession
    importable(spark)
    work = Workspace(spark)
    texts = docs.select(
        F.col(doc_id).cast("bigint").alias("doc_id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text")
    )
    met = texts.mapInArrow(
        _profiles(shingle, percent), "doc_id bigint, tag bigint, n int, nid bigint, prefix array<bigint>"
    )
    met = work.write(met, "prefixes")
    frequent = (
        met.select(F.explode("prefix").alias("token"))
        .groupBy("token")
        .count()
        .filter(F.col("count") > HEAVY)
        .orderBy(F.desc("count"), "token")
        .limit(HEAVY_TOKENS)
        .select("token")
    )
    heavy = np.sort(frequent.toPandas()["token"].to_numpy(np.int64).astype(np.uint64))
    profiles = work.write(met.select("doc_id", "tag", "n", "nid"), "profiles")
    work.drop("prefixes")
    shared = spark.sparkContext.broadcast(heavy)

    postings = texts.select("text").mapInArrow(
        _postings(shingle, percent, shared), "token bigint, n int, pos int, nid bigint"
    )
    lists = postings.repartition("token").sortWithinPartitions("token", "n", "nid")
    first = work.write(lists.mapInArrow(_first_round(percent), _EDGE_DDL), "lists")
    pairs = work.write(first.filter("token IS NULL").select("n", "nid", "n2", "nid2").distinct(), "pairs")

    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))
    classes = work.write(
        profiles.filter("n > 0").groupBy("n", "nid").agg(F.min(order).alias("first")).select(
            "n", "nid", F.col("first.doc_id").alias("doc_id"), F.col("first.tag").alias("tag")
        ),
        "classes",
    )
    long = first.filter("token IS NOT NULL").select("token", "n", "pos", "nid")
    ends = pairs.select("n", "nid").unionByName(pairs.select("n2", "nid2").toDF("n", "nid"))
    ends = ends.unionByName(long.select("n", "nid")).distinct()
    wanted = work.write(classes.join(ends, ["n", "nid"], "left_semi"), "wanted")
    known = wanted.select("n", "nid", _key().alias("key"), "tag")
    # Texts that no candidate needs stay where they are.
    asked, _ = Bits(known, F.xxhash64("key", "tag")).split(
        texts.select(_key().alias("key"), "tag", "text"), F.xxhash64("key", "tag")
    )
    bodies = asked.join(known, ["key", "tag"]).groupBy("key", "tag").agg(
        F.first("n").alias("n"), F.first("nid").alias("nid"), F.first("text").alias("text")
    )
    bodies = work.write(bodies.select("n", "nid", "text"), "bodies")

    def verify(candidates: DataFrame) -> DataFrame:
        other = bodies.select(F.col("n").alias("n2"), F.col("nid").alias("nid2"), F.col("text").alias("text2"))
        both = candidates.join(bodies, ["n", "nid"]).join(other, ["n2", "nid2"])
        return both.select("n", "nid", "n2", "nid2", "text", "text2").mapInArrow(
            _verified(shingle, percent), "n int, nid bigint, n2 int, nid2 bigint"
        )

    edges = work.write(verify(pairs), "edges")
    stars = edges.select(_node().alias("u"), _node("n2", "nid2").alias("v"))
    found = components(stars, work, "round1")
    labelled = long.withColumn("node", _node()).join(found, "node", "left")
    labelled = labelled.select(
        "token", "n", "pos", "nid", F.xxhash64(F.coalesce("component", "node")).alias("part")
    )
    split = labelled.groupBy("token").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a <> b")
    outlines = bodies.select("n", "nid", "text").mapInArrow(
        _outlines(shingle), "n int, nid bigint, " + ", ".join(f"{b} bigint" for b in _OUTLINE)
    )
    rest = labelled.join(split.select("token"), "token").join(outlines, ["n", "nid"])
    rest = rest.select("token", "n", "pos", "nid", "part", *_OUTLINE)
    rest = rest.repartition("token").sortWithinPartitions("token", "n", "nid")
    more = rest.mapInArrow(_second_round(percent), _EDGE_DDL).select("n", "nid", "n2", "nid2").distinct()
    more = work.write(more.join(pairs, ["n", "nid", "n2", "nid2"], "left_anti"), "more")
    if not more.isEmpty():
        late = work.write(verify(more), "late")
        links_between = late.select(_node().alias("u"), _node("n2", "nid2").alias("v"))
        stars = found.filter("node <> component").toDF("u", "v").unionByName(links_between)
        found = components(stars, work, "round2")
    work.drop("lists", "pairs", "bodies", "wanted", "more")

    named = classes.select(_node().alias("node"), "doc_id").join(found, "node", "left")
    named = named.withColumn("component", F.coalesce("component", "node"))
    smallest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    names = named.join(smallest, "component").select(
        "node.n", "node.nid", "component_id", F.xxhash64("component").alias("component")
    )
    out = profiles.join(names, ["n", "nid"], "left")
    own = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select(
        "doc_id", "tag", F.col("n").cast("bigint").alias("n_shingles"), own.alias("component_id"), "component"
    )


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without those that a kept row is connected with.

    The row with the smallest id stays; of several rows with that id, one.
    Documents without words all stay.
    """
    work = Workspace(docs.sparkSession)
    met = work.write(links(docs, doc_id, text, **options).filter("n_shingles > 0"), "links")
    keys = met.groupBy(_key().alias("__key"), "tag").agg(
        F.first("component").alias("group"), F.first("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("rows")
    )
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("tag"))).alias("best")
    kept = keys.join(keys.groupBy("group").agg(best), "group")
    same = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("tag") == F.col("best.tag"))
    kept = kept.select("__key", F.col("tag").alias("__tag"), same.alias("__stays"), "rows")
    # Rows that go, and rows that stay but occur several times.
    kept = work.write(kept.filter("NOT __stays OR rows > 1").drop("rows"), "changed")

    rows = docs.select(
        F.struct("*").alias("__row"), _key(doc_id).alias("__key"), F.xxhash64(F.col(text)).alias("__tag")
    )
    bits = Bits(kept, F.xxhash64("__key", "__tag"))
    maybe, clear = bits.split(rows, F.xxhash64("__key", "__tag"))
    met = maybe.join(kept, ["__key", "__tag"], "left")
    once = met.filter("__stays").groupBy("__key", "__tag").agg(F.first("__row").alias("__row"))
    out = clear.select("__row").unionByName(met.filter("__stays IS NULL").select("__row"))
    return out.unionByName(once.select("__row")).select("__row.*")
