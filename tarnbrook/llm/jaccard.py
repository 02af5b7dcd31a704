"""Exact Jaccard self-join of 5-word shingle sets with token-combination prefixes.

Tokens (shingle hashes) are put in one global order, rare ones first. Two sets with
Jaccard similarity t or more lack at most n - ceil(t n) of each other's tokens, so
a prefix of each that can't be lacking as a whole must share something:

* class 1 (rare tokens) is indexed by single tokens,
* class 2 (frequent tokens) by combinations of ``2`` tokens, for texts of any length.

All combinations of a long prefix would be too many, so frequent tokens are dealt by
hash into g groups and only tokens of one group are combined. The prefix is extended
by g tokens for them: of g + 1 shared tokens two are in one group. g grows with the
sets (the larger one's size, as a power of two, by ``GROUP_PART``), so a set of n
tokens has at most about 1.4 n combinations; a set near the next power of two is
indexed with that one's groups too, which is counted in this.

Frequencies come from lossy counting over all texts (each task counts the tokens
that repeat within bounded batches, and Spark sums them). They only steer the order
and the classes: any order gives the same links. The most frequent ``ORDERED``
tokens are broadcast; the others follow the order of their hashes.

A signature's sets are not compared all with all. In each signature the set that
shares most signatures overall stands first. Each set is verified with the one of
these that it meets most often; what links becomes a component. Then, within each
signature, only sets of different components are verified, all of them that their
sizes, the places of the shared tokens and counts of their tokens by hash do not rule
out. So large groups of near copies cost about one check per member, and no link
between components is missed. Sets are verified on their texts.

A combination's place is the number of own tokens its set has at least before the
second shared one (those before it, less one for each group among them), so sets that
only share a passage are ruled out by place as in plain prefix filters. More tokens to
a combination would not part such sets, as a passage's tokens come together. Signatures with more than ``SPLIT_ROWS`` sets are cut
into blocks over many tasks, and there the counts of tokens are compared before a pair
is given out. Sets that come too late to be like one of their own size ("tight") are
compared only with the others there, as no two of them can be similar enough.

Rows with equal sets are one node. Nodes are 64-bit hashes of the whole set. Rows
without doc_id, and texts without words, link with nothing. Repeated doc_ids are
rows of their own. Other columns than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnbrook.llm.arrays import SPACED_LOWER, chunks, grams, mix, ranges, text_bytes, words
from tarnbrook.llm.components import connect
from tarnbrook.operators.lookup import find_hot_keys, lookup
from tarnbrook.session import materialize

SHINGLE = 5
#: Similarity as a fraction.
PART, OF = 3, 4
#: The larger set's tokens (as a power of two) to a group of frequent ones.
GROUP_PART = 8
ORDERED = 1 << 20
ORDER_FROM = 8
CLASS_2_FROM = 256
COUNTED_AT_ONCE = 1 << 21


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(token, row) of the distinct shingles of each row of a chunk, by row and token."""
    w = words(data, offsets, SPACED_LOWER)
    count = np.diff(w.first)
    full = np.flatnonzero(count >= SHINGLE)
    tokens, rows = [], []
    if len(full):
        starts = ranges(w.first[:-1][full], count[full] - SHINGLE + 1)
        tokens.append(grams(w.hashes, SHINGLE)[starts])
        rows.append(np.repeat(full, count[full] - SHINGLE + 1))
    for size in range(1, SHINGLE):
        short = np.flatnonzero(count == size)
        if len(short):
            tokens.append(grams(w.hashes, size)[w.first[:-1][short]])
            rows.append(short)
    if not tokens:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    token, row = np.concatenate(tokens), np.concatenate(rows)
    order = np.lexsort((token, row))
    token, row = token[order], row[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
    return token[new], row[new]


def set_nodes(token: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name for each row's whole set (0 for the empty set)."""
    out = np.zeros(len(sizes), dtype=np.uint64)
    some = np.flatnonzero(sizes)
    if len(some):
        starts = (np.cumsum(sizes) - sizes)[some]
        a = np.add.reduceat(mix(token, 1), starts)
        b = np.add.reduceat(mix(token, 2), starts)
        out[some] = mix(a ^ mix(b + sizes[some].astype(np.uint64), 3), 4)
    return out.view(np.int64)


def _sets(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, end row, token, starts, sizes, nodes) per chunk."""
    for first, end, data, offsets in chunks(batch):
        token, row = shingle_sets(data, offsets)
        sizes = np.bincount(row, minlength=end - first)
        yield first, end, token, np.cumsum(sizes) - sizes, sizes, set_nodes(token, sizes)


_PROFILE = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("n", pa.int64()), ("token", pa.int64()), ("times", pa.int64())])


def _profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document (doc_id, node, n), and rows (token, times) of tokens that repeat."""
    held: list[np.ndarray] = []
    seen: set[int] = set()

    def repeats() -> pa.RecordBatch:
        token, times = np.unique(np.concatenate(held), return_counts=True)
        token, times = token[times > 1], times[times > 1]
        held.clear()
        seen.clear()
        none = pa.nulls(len(token), pa.int64())
        return pa.RecordBatch.from_arrays([none, none, none, pa.array(token.view(np.int64)), pa.array(times)], schema=_PROFILE)

    for batch in batches:
        for first, end, token, starts, sizes, nodes in _sets(batch):
            none = pa.nulls(end - first, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(nodes), pa.array(sizes.astype(np.int64)), none, none], schema=_PROFILE)
            fresh = np.zeros(len(nodes), dtype=bool)
            for i, node in enumerate(nodes.tolist()):
                if node not in seen:
                    seen.add(node)
                    fresh[i] = True
            held.append(token[ranges(starts[fresh], sizes[fresh])])
            if sum(map(len, held)) >= COUNTED_AT_ONCE:
                yield repeats()
    if held:
        yield repeats()


def frequent_tokens(profile: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(token, times) of the most frequent tokens, by token; bounded by ``ORDERED``."""
    counted = profile.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).where(F.col("times") >= ORDER_FROM)
    rows = counted.orderBy(F.desc("times"), "token").limit(ORDERED).toArrow()
    token = rows.column("token").to_numpy().view(np.uint64)
    order = np.argsort(token)
    return token[order], rows.column("times").to_numpy()[order]


def token_groups(n: int) -> int:
    """Into how many groups frequent tokens are dealt where the larger of two sets has ``n`` tokens: a power of two, equal from each power of two to the next."""
    return max(1, (1 << n.bit_length() - 1) // GROUP_PART)


def combined(token: np.ndarray, rare: int, end: int, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, place) of the pairs of tokens of one group among the tokens from ``rare`` to ``end``."""
    token = token[rare:end]
    group = (mix(token, 7) & np.uint64(groups - 1)).astype(np.int64)
    opens = np.zeros(len(token), dtype=np.int64)
    opens[np.unique(group, return_index=True)[1]] = 1
    place = rare + np.arange(len(token)) - (np.cumsum(opens) - opens)
    order = np.argsort(group, kind="stable")
    token, group, place = token[order], group[order], place[order]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for apart in range(1, len(token)):
        at = np.flatnonzero(group[apart:] == group[:-apart])
        if not len(at):
            break
        found.append((token[at], at + apart))
    if not found:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    first, second = (np.concatenate(f) for f in zip(*found, strict=True))
    with np.errstate(over="ignore"):
        return mix(mix(first, 5) + token[second] + np.uint64(groups), 6), place[second]


def signatures(token: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(signature, place) of one set, given its tokens and their frequencies.

    Two similar sets meet in a signature at whose places each of them shares at most
    what follows: single tokens at their own place, combinations at their second
    token's, less the groups that stand before it among the frequent tokens.
    """
    n = len(token)
    order = np.lexsort((token, times))
    token, times = token[order], times[order]
    needed = -(-PART * n // OF)
    rare = int(np.searchsorted(times, CLASS_2_FROM))
    single = min(rare, n - needed + 1)
    found = [(token[:single], np.arange(single))]
    own, above = token_groups(n), token_groups(OF * n // PART)
    if rare <= n - needed:
        found.append(combined(token, rare, n - needed + own + 1, own))
    if above != own:
        # Sets of the next power of two share more with this one.
        needed = -(-PART * (1 << n.bit_length()) // OF)
        if rare <= n - needed:
            found.append(combined(token, rare, n - needed + above + 1, above))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


_SIGNATURES = pa.schema([("sig", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32())])


def _signature_rows(shared: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, often = shared.value
        for batch in batches:
            for _, _, token, starts, sizes, nodes in _sets(batch):
                times = np.zeros(len(token), dtype=np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                    hit = known[at] == token
                    times[hit] = often[at[hit]]
                # Sets of fewer than 3 tokens are only like sets equal to them.
                rows = np.flatnonzero(sizes >= 3)
                found = [signatures(token[starts[r] : starts[r] + sizes[r]], times[starts[r] : starts[r] + sizes[r]]) for r in rows]
                if found:
                    lengths = np.array([len(f[0]) for f in found])
                    cells = [np.concatenate([f[0] for f in found]).view(np.int64), np.repeat(nodes[rows], lengths), np.repeat(sizes[rows], lengths), np.concatenate([f[1] for f in found])]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(f.type.to_pandas_dtype())) for c, f in zip(cells, _SIGNATURES, strict=True)], schema=_SIGNATURES)

    return run


def _bucket_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (sig, node): the distinct rows of signatures that several nodes have. Holds one batch."""
    last = None  # the latest row (sig, node, n, place), and whether it was given out
    for batch in batches:
        columns = [batch.column(f.name).to_numpy() for f in _SIGNATURES]
        if last is not None:
            columns = [np.concatenate(([v], c)) for v, c in zip(last[0], columns, strict=True)]
        sig, node = columns[:2]
        if not len(sig):
            continue
        new = np.ones(len(sig), dtype=bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        at = np.flatnonzero(new)
        same = sig[at[1:]] == sig[at[:-1]]
        many = np.zeros(len(at), dtype=bool)
        many[1:] |= same
        many[:-1] |= same
        given = many.copy()
        if last is not None:
            given[0] &= not last[1]
            many[0] |= last[1]
        out = at[given]
        last = ([c[at[-1]] for c in columns], bool(many[-1]))
        if len(out):
            yield pa.RecordBatch.from_arrays([pa.array(c[out].astype(f.type.to_pandas_dtype())) for c, f in zip(columns, _SIGNATURES, strict=True)], schema=_SIGNATURES)


_STARS = pa.schema([("hub", pa.int64()), ("node", pa.int64())])


def _fits(n: np.ndarray, place: np.ndarray, other_n: np.ndarray, other_place: np.ndarray) -> np.ndarray:
    """Whether two sets whose first shared token stands at these places can be similar enough.

    They share at most what follows in both, and need PART / (PART + OF) of the sum
    of their sizes. A pair that is similar enough passes at its first shared token.
    """
    return (PART + OF) * np.minimum(n - place, other_n - other_place) >= PART * (n + other_n)


def _star_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (sig, node, n, place) sorted by sig, the most sharing node first: each node beside its signature's first one."""
    hub = None
    for batch in batches:
        sig, node, n, place = (batch.column(f.name).to_numpy() for f in _SIGNATURES)
        if not len(sig):
            continue
        starts = np.ones(len(sig), dtype=bool)
        starts[1:] = sig[1:] != sig[:-1]
        starts[0] = hub is None or hub[0] != sig[0]
        at = np.maximum.accumulate(np.where(starts, np.arange(len(sig)), -1))
        first = [np.where(at >= 0, c[at], 0) for c in (node, n, place)]
        if not starts[0]:
            for c, v in zip(first, hub[1:], strict=True):
                c[at < 0] = v
        hub = (sig[-1], *(c[-1] for c in first))
        good = (node != first[0]) & _fits(n, place, first[1], first[2])
        if good.any():
            yield pa.RecordBatch.from_arrays([pa.array(first[0][good]), pa.array(node[good])], schema=_STARS)


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])
PAIR_BLOCK = 1 << 16
#: Signatures with more sets than this are cut into blocks of BLOCK_ROWS.
SPLIT_ROWS = 256
BLOCK_ROWS = 1024


def _crossing_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (sig, root, node, n, place) sorted by sig: pairs of different roots within a signature that can be similar enough."""

    def emit(rows: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        root, node, n, place = rows
        if len(node) < 2 or (root == root[0]).all():
            return
        step = max(1, PAIR_BLOCK // len(node))
        for at in range(0, len(node), step):
            part = slice(at, at + step)
            i, j = np.nonzero((root[part, None] != root) & (node[part, None] < node) & _fits(n[part, None], place[part, None], n, place))
            if len(i):
                yield pa.RecordBatch.from_arrays([pa.array(node[part][i]), pa.array(node[j])], schema=_PAIRS)

    open_: list[list[np.ndarray]] = []
    current = None
    for batch in batches:
        sig, root, node, n, place = (batch.column(c).to_numpy() for c in ("sig", "root", "node", "n", "place"))
        cuts = np.concatenate(([0], np.flatnonzero(sig[1:] != sig[:-1]) + 1, [len(sig)])) if len(sig) else [0]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if current is not None and sig[a] != current:
                yield from emit([np.concatenate(x) for x in zip(*open_, strict=True)])
                open_ = []
            current = sig[a]
            open_.append([root[a:b], node[a:b], n[a:b], place[a:b]])
    if open_:
        yield from emit([np.concatenate(x) for x in zip(*open_, strict=True)])


SKETCH_MOST = 1 << 12


def sketch(token: np.ndarray) -> bytes:
    """Tokens counted by the low bits of their hashes, in about one bucket per token."""
    buckets = 1 << min(max(6, (len(token) - 1).bit_length()), SKETCH_MOST.bit_length() - 1) if len(token) else 64
    counts = np.bincount((token & np.uint64(buckets - 1)).astype(np.int64), minlength=buckets)
    return counts.astype(np.uint16 if counts.max(initial=0) > 255 else np.uint8).tobytes() + bytes([buckets.bit_length(), 1 + int(counts.max(initial=0) > 255)])


def _counts(packed: bytes) -> np.ndarray:
    return np.frombuffer(packed[:-2], dtype=np.uint8 if packed[-1] == 1 else np.uint16).astype(np.int64)


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """No two sets with these counts share more tokens than this."""
    size = min(len(a), len(b))
    return int(np.minimum(a.reshape(-1, size).sum(axis=0), b.reshape(-1, size).sum(axis=0)).sum())


def _block_pairs(table: pa.Table) -> pa.Table:
    """Rows (root, node, n, place, left, sketch) of a block: the pairs of a left and another row, of different roots, that places and sketches do not rule out."""
    root, node, n, place, left = (table.column(c).to_numpy() for c in ("root", "node", "n", "place", "left"))
    counts = [_counts(x.as_py()) for x in table.column("sketch")]
    lefts, rights = np.flatnonzero(left), np.flatnonzero(~left)
    width = np.array([len(c) for c in counts])
    by_width = {int(w): rights[width[rights] == w] for w in np.unique(width[rights])}
    packed = {w: np.stack([counts[j] for j in rows]) for w, rows in by_width.items()}
    loose = n >= (PART + OF) * place
    found = []
    for i in lefts:
        for w, rows in by_width.items():
            # Two loose rows meet twice.
            good = (root[rows] != root[i]) & (~loose[rows] | (node[i] < node[rows])) & _fits(n[i], place[i], n[rows], place[rows])
            at = np.flatnonzero(good)
            size = min(w, int(width[i]))
            mine = counts[i].reshape(-1, size).sum(axis=0)
            for k in range(0, len(at), SKETCHES_AT_ONCE):
                part = at[k : k + SKETCHES_AT_ONCE]
                others = packed[w][part].reshape(len(part), -1, size).sum(axis=1)
                shared = np.minimum(others, mine).sum(axis=1)
                j = rows[part[(PART + OF) * shared >= PART * (n[i] + n[rows[part]])]]
                if len(j):
                    found.append((np.minimum(node[i], node[j]), np.maximum(node[i], node[j])))
    a, b = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
    return pa.table([pa.array(a), pa.array(b)], schema=_PAIRS)


SKETCHES_AT_ONCE = 256


def crossing(labelled: DataFrame, buckets: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b), a < b: the nodes of different roots that share a signature and that their places do not rule out.

    ``labelled`` has the rows of ``buckets`` with their roots. In signatures of many
    rows the pairs have passed the sketches too.
    """
    large = materialize(buckets.groupBy("sig").count().where(F.col("count") > SPLIT_ROWS).select("sig"), "large-buckets")
    few = labelled.join(large, "sig", "left_anti") if not large.isEmpty() else labelled
    pairs = few.repartition("sig").sortWithinPartitions("sig").mapInArrow(_crossing_pairs, "a long, b long")
    if large.isEmpty():
        return pairs.distinct()
    many = labelled.join(large, "sig").withColumn("loose", F.col("n") >= (PART + OF) * F.col("place"))
    many = materialize(many, "large-bucket-rows")
    # Only rows that some row may be like: tight rows of no loose one, and those of one root, are left out.
    blocks = many.groupBy("sig").agg(
        F.ceil(F.count_if("loose") / BLOCK_ROWS).cast("int").alias("xs"), F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("ys"),
        F.min("root").alias("low"), F.max("root").alias("high"),
    ).where("xs > 0 and low < high").select("sig", "xs", "ys")
    cut = many.join(blocks, "sig")
    name = F.xxhash64("node")
    left = cut.where("loose").select("*", F.pmod(name, "xs").cast("int").alias("x"), F.explode(F.sequence(F.lit(0), F.col("ys") - 1)).alias("y"), F.lit(True).alias("left"))
    right = cut.select("*", F.explode(F.sequence(F.lit(0), F.col("xs") - 1)).alias("x"), F.pmod(name, "ys").cast("int").alias("y"), F.lit(False).alias("left"))
    rows = left.unionByName(right).join(texts.select("node", "sketch"), "node").select("sig", "x", "y", "root", "node", "n", "place", "left", "sketch")
    return pairs.union(rows.groupBy("sig", "x", "y").applyInArrow(_block_pairs, "a long, b long")).distinct()


def _possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs whose sketches do not rule the similarity out."""
    for batch in batches:
        left, known, good = None, None, []
        for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
            x = x.as_py()
            if x != left:
                left, known = x, _counts(x)
            other = _counts(y.as_py())
            good.append((PART + OF) * most_shared(known, other) >= PART * int(known.sum() + other.sum()))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


def _packed_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("node", pa.int64()), ("packed", pa.binary()), ("sketch", pa.binary())])
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for first, end, data, offsets in chunks(batch):
            token, row = shingle_sets(data, offsets)
            sizes = np.bincount(row, minlength=end - first)
            nodes, starts = set_nodes(token, sizes), np.cumsum(sizes) - sizes
            sketches = [sketch(token[a : a + n]) for a, n in zip(starts, sizes, strict=True)]
            packed = [pack.compress(data[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, end - first), pa.array(nodes), pa.array(packed, pa.binary()), pa.array(sketches, pa.binary())], schema=schema)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("linked", pa.bool_())])
    unpack = zstandard.ZstdDecompressor()

    def tokens(packed: bytes) -> np.ndarray:
        data, offsets = text_bytes(pa.array([unpack.decompress(packed)], pa.binary()))
        return shingle_sets(data, offsets)[0]

    for batch in batches:
        linked, left, known = [], None, None
        for x, y in zip(batch.column("left"), batch.column("right"), strict=True):
            x = x.as_py()
            if x != left:
                left, known = x, tokens(x)
            other = tokens(y.as_py())
            both = len(np.intersect1d(known, other, assume_unique=True))
            linked.append(OF * both >= PART * (len(known) + len(other) - both))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], schema=schema)


def _beside(pairs: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    left = texts.select(F.col("node").alias("a"), F.col(column).alias("left"))
    right = texts.select(F.col("node").alias("b"), F.col(column).alias("right"))
    return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, linked) of pairs of nodes, decided on their texts."""
    return _beside(pairs, texts, "packed").mapInArrow(_verified, "a long, b long, linked boolean")


def similar_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row; a component's id is the smallest doc_id in it."""
    spark = docs.sparkSession
    rows = docs.select("doc_id", "text")
    named = rows.where("doc_id is not null")
    profile = materialize(rows.mapInArrow(_profile, "doc_id long, node long, n long, token long, times long"), "shingle-profile")
    sets = profile.where("n is not null").select("doc_id", "node", "n")
    shared = spark.sparkContext.broadcast(frequent_tokens(profile))

    rows_of = "sig long, node long, n int, place int"
    found = named.mapInArrow(_signature_rows(shared), rows_of)
    # No number of partitions: the session's, made fewer or more by AQE.
    buckets = materialize(found.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(_bucket_rows, rows_of), "buckets")
    sharing = buckets.groupBy("node").agg(F.count("*").alias("sharing"))
    texts = named.mapInArrow(_packed_texts, "doc_id long, node long, packed binary, sketch binary")
    places = sets.where("doc_id is not null and n > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id")).join(sharing.select("node"), "node")
    texts = materialize(texts.join(places, ["doc_id", "node"]), "candidate-texts")

    # The node that shares most signatures is likely the text that the others were copied from.
    stars = buckets.join(sharing, "node").repartition("sig").sortWithinPartitions("sig", F.desc("sharing"), "node").select(*buckets.columns).mapInArrow(_star_rows, "hub long, node long")
    best = stars.groupBy("node", "hub").count().groupBy("node").agg(F.max(F.struct("count", "hub")).alias("m"))
    first = materialize(verify(best.select(F.col("m.hub").alias("a"), F.col("node").alias("b")), texts), "verified")
    links = first.where("linked").select("a", "b")
    labels = connect(links)

    labelled = buckets.join(labels, "node", "left").select("sig", F.coalesce("root", "node").alias("root"), "node", "n", "place")
    refused = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    possible = _beside(crossing(labelled, buckets, texts).join(refused, ["a", "b"], "left_anti"), texts, "sketch").mapInArrow(_possible, "a long, b long")
    second = materialize(verify(materialize(possible, "possible-pairs"), texts), "verified")
    labels = connect(links.union(second.where("linked").select("a", "b")))

    # A set with many copies and a component with many rows are hot keys of these joins.
    placed = lookup(sets, labels, "node", find_hot_keys(sets, ["node"])["node"], ["doc_id"]).withColumn("root", F.coalesce("root", "node"))
    placed = materialize(placed, "placed")
    smallest = placed.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return lookup(placed, smallest, "root", find_hot_keys(placed, ["root"])["root"], ["doc_id"]).select(
        "doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("smallest")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (all columns) that have the smallest doc_id of their component, or no doc_id.

    Where several rows share that doc_id, one of them stays for each text.
    """
    kept = materialize(similar_sets(docs).where("doc_id = component_id").groupBy("doc_id").count(), "kept-ids")
    named = docs.where("doc_id is not null").join(kept.select("doc_id"), "doc_id", "left_semi")
    if not kept.where("count > 1").isEmpty():
        named = named.dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.where("doc_id is null"))
