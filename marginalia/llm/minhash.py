"""Near duplicates by an inverted join over signature coordinates.

1. A text's set holds its distinct word shingles; its signature is the least of COORDINATES
   hashes of them. Texts with equal sets are one node from here on, so copies cost one row.
2. Nodes are posted under each (coordinate, value). Two sets with similarity 0.8 collide in at
   least MATCHES coordinates (one pair in 100,000 does not), so they share one of the
   ``COORDINATES - MATCHES + 1`` rarest postings of either. Only this prefix of postings is merged;
   the frequent rest is skipped and only looked up when collisions are counted.
3. In a posting list every node is paired with its *hub*, the node whose coordinates are the most
   common ones: the original of a group of edited copies. Pairs with enough collisions are
   confirmed on the full sets and give components.
4. Lists with the same hub are taken together. Those whose nodes are all in one component are
   finished. In the others nodes of different components are compared in blocks: by their
   sizes and collisions first, which leaves few nodes; then by how many of their shingles any
   other of these sets has, and by the full sets. Only confirmed links leave a block. Nothing
   is capped: a long list has more blocks.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z are lower-cased. A text with fewer words than a
shingle has its whole sequence as its only shingle; NULL, empty and blank texts have an empty
set and are linked with nothing. Rows that repeat a ``doc_id`` are separate texts; a row
without ``doc_id`` takes no part (its component is NULL, it is kept). An empty table gives no rows;
other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marginalia.functions.bloom import bloom_filter, may_contain
from marginalia.llm.batches import pieces, texts_of
from marginalia.llm.components import components
from marginalia.sources.paths import stored

COORDINATES = 64
MATCHES = 36
PREFIX = COORDINATES - MATCHES + 1
# Tells texts of one doc_id apart.
TEXT_HASH = "xxhash64(coalesce(text, ''))"
# Nodes of a posting list that are compared with one another in one piece of work.
BLOCK = 256
HASH_BLOCK = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def _byte_values() -> np.ndarray:
    values = np.random.default_rng(8).integers(1, 1 << 63, 256, np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


_VALUES = _byte_values()
_FACTORS = np.random.default_rng(9).integers(1, 1 << 63, COORDINATES, np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = np.random.default_rng(10).integers(1, 1 << 63, COORDINATES, np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of every word, in blocks of about a megabyte that end at white space."""
    hashes, starts = [], []
    at = 0
    while at < len(text):
        end = min(len(text), at + HASH_BLOCK)
        data = np.frombuffer(text, np.uint8, end - at, at)
        while end < len(text) and not _WHITE[text[end - 1]]:
            more = np.flatnonzero(_WHITE[np.frombuffer(text, np.uint8, min(HASH_BLOCK, len(text) - end), end)])
            end = end + int(more[0]) + 1 if len(more) else min(len(text), end + HASH_BLOCK)
            data = np.frombuffer(text, np.uint8, end - at, at)
        inside = np.concatenate([[False], ~_WHITE[data], [False]])
        change = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = change[::2], change[1::2]
        power = np.cumprod(np.full(len(data), _BASE))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * power)])
        back = np.cumprod(np.full(len(data) + 1, _INVERSE))
        hashes.append(_mix((sums[last] - sums[first]) * back[first]))
        starts.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(starts)


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) + 1 for r in raw])])
    hashes, starts = word_hashes(b"\n".join(raw))
    bounds = np.searchsorted(starts, offsets)
    rolled = hashes
    for k in range(1, words):
        rolled = _mix(rolled[: max(0, len(hashes) - k)] * np.uint64(3)) + hashes[k:]
    sets = []
    for a, b in zip(bounds.tolist(), bounds[1:].tolist()):
        if b - a >= words:
            sets.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            whole = hashes[a : a + 1]
            for i in range(a + 1, b):
                whole = _mix(whole * np.uint64(3)) + hashes[i : i + 1]
            sets.append(_mix(whole + np.uint64(b - a)))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def signatures_of(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, COORDINATES) least 31-bit hashes; rows of empty sets mean nothing."""
    sizes = np.array([max(1, len(s)) for s in sets])
    flat = np.concatenate([s if len(s) else np.zeros(1, np.uint64) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    out = np.empty((len(sets), COORDINATES), np.int32)
    for c in range(COORDINATES):
        hashed = (flat ^ _MASKS[c]) * _FACTORS[c]
        out[:, c] = np.minimum.reduceat(hashed, starts) >> np.uint64(33)
    return out


_SIGNED = "doc_id long, text_hash long, n_shingles long, node long, signature array<int>"
_SETS = "node long, shingles array<long>"


def _node(found: np.ndarray) -> int | None:
    """What texts with this set are known by."""
    return int.from_bytes(blake2b(found.tobytes(), digest_size=8).digest(), "little", signed=True) if len(found) else None


def _signer(words: int) -> Callable[[Iterator], Iterator]:
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("text_hash", pa.int64()),
            ("n_shingles", pa.int64()),
            ("node", pa.int64()),
            ("signature", pa.list_(pa.int32())),
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            sets = shingle_sets(texts_of(piece), words)
            signed = signatures_of(sets)
            ends = pa.array(np.arange(0, signed.size + 1, COORDINATES), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    piece.column("doc_id"),
                    piece.column("text_hash"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_node(s) for s in sets], pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(signed.ravel())),
                ],
                schema=schema,
            )

    return sign


def _setter(words: int) -> Callable[[Iterator], Iterator]:
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            # Of rows that repeat a doc_id, only the text that made the node counts.
            found = [
                (node, s.view(np.int64))
                for node, s in zip(piece.column("node").to_pylist(), shingle_sets(texts_of(piece), words))
                if _node(s) == node
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([s for _, s in found], pa.list_(pa.int64()))],
                names=["node", "shingles"],
            )

    return sets


@dataclass(frozen=True)
class Rule:
    """Shingles of ``words`` words; linked where 100 * common >= percent * union."""

    words: int = 5
    percent: int = 80


def _prefixes(nodes: DataFrame) -> DataFrame:
    """node, n_shingles, token, central: the rarest postings of nodes that may have a partner.

    A posting that one node alone has cannot be shared, but takes up its place in the prefix.
    """
    tokens = nodes.select("node", F.posexplode("signature").alias("at", "value")).select(
        "node", (F.shiftleft(F.col("at").cast("long"), 32) + F.col("value")).alias("token")
    )
    counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = tokens.join(stored(counts, "tokens"), "token")
    lists = shared.groupBy("node").agg(
        F.sort_array(F.collect_list(F.struct("held", "token"))).alias("held"),
        F.sum(F.log("held")).alias("central"),
    )
    room = F.lit(PREFIX - COORDINATES) + F.size("held")
    return lists.filter(room > 0).select(
        "node", "central", F.explode(F.slice("held", 1, room)).alias("posting")
    ).select("node", "central", F.col("posting.token").alias("token"))


def _collisions(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))


def _confirmed(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets are similar enough."""
    joined = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b"
    )
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return joined.select("a", "b", "sa", "sb", common.alias("common")).filter(
        100 * F.col("common") >= rule.percent * union
    ).select("a", "b")


def _by_hub(prefixes: DataFrame) -> DataFrame:
    """hub, node: the members of all posting lists that have the same hub, itself included."""
    hubs = prefixes.groupBy("token").agg(
        F.max_by("node", F.struct("central", "node")).alias("hub"), F.count(F.lit(1)).alias("n")
    )
    hubs = stored(hubs.filter("n > 1").drop("n"), "hubs")
    return prefixes.join(hubs, "token").select("hub", "node").distinct()


def _hub_pairs(members: DataFrame, nodes: DataFrame, rule: Rule) -> DataFrame:
    """Each node with the hubs of its posting lists, if they collide often enough."""
    pairs = members.filter("node <> hub").select(
        F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")
    ).distinct()
    of = nodes.select("node", "n_shingles", "signature")
    left, right = (of.select(*[F.col(c).alias(f"{c}_{s}") for c in of.columns]) for s in "ab")
    both = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    small, large = F.least("n_shingles_a", "n_shingles_b"), F.greatest("n_shingles_a", "n_shingles_b")
    return both.filter(100 * small >= rule.percent * large).filter(
        _collisions(F.col("signature_a"), F.col("signature_b")) >= MATCHES
    ).select("a", "b")


def _open_members(members: DataFrame, nodes: DataFrame, roots: DataFrame, rule: Rule) -> DataFrame:
    """Members of the lists that hold nodes of several components, by size class.

    Sets of one class, or of neighbouring ones, may be similar; each node is also a guest one
    class up.
    """
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / F.lit(float(np.log(100 / rule.percent)))).cast("int")
    dealt = (
        members.join(nodes.select("node", "n_shingles"), "node")
        .join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
        .withColumn("home", size_class)
        .withColumn("class", F.explode(F.array(F.col("home"), F.col("home") + 1)))
        .withColumn("is_home", F.col("home") == F.col("class"))
        .select("hub", "class", "node", "root", "n_shingles", "is_home")
    )
    lists = dealt.groupBy("hub", "class").agg(
        F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"),
        F.bool_or("is_home").alias("homes"),
    ).filter("low <> high and homes")
    lists = stored(lists.select("hub", "class", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "open-lists")
    return stored(dealt.join(lists, ["hub", "class"]), "open-members")


def _shared(sets: DataFrame, percent: int) -> DataFrame:
    """node, shared: how many of its shingles any other set has too, where that may be enough.

    A shingle that no other set has is never common, so ``shared`` bounds what two sets have
    in common.
    """
    alone = (
        sets.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count(F.lit(1)).alias("held"), F.min("node").alias("node"))
        .filter("held = 1")
        .groupBy("node")
        .agg(F.count(F.lit(1)).alias("alone"))
    )
    sizes = sets.select("node", F.size("shingles").cast("long").alias("size"))
    return sizes.join(alone, "node", "left").select(
        "node", (F.col("size") - F.coalesce("alone", F.lit(0))).alias("shared"), "size"
    ).filter(100 * F.col("shared") >= percent * F.col("size")).drop("size")


def _blocks(members: DataFrame, details: DataFrame) -> DataFrame:
    """Every block of a list beside every other: the rows of one are with those of its partner."""
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return members.join(details, "node").withColumn("block", block).withColumn("other", other).select(
        "hub", "class",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block", "node", "root", "n_shingles", "is_home",
        *[c for c in details.columns if c != "node"],
    )


@dataclass(frozen=True)
class _Block:
    """Rows of two blocks as arrays."""

    table: pa.Table
    percent: int

    def pairs(self, shared: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """A row of one block, and those of the other that may be similar to it."""
        table, percent = self.table, self.percent
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        block, root, size, home = (table.column(c).to_numpy() for c in ("block", "root", "n_shingles", "is_home"))
        signed = table.column("signature").combine_chunks().flatten().to_numpy().reshape(-1, COORDINATES)
        right = np.flatnonzero(block == high)
        for i in np.flatnonzero(block == low).tolist():
            js = right[right > i] if low == high else right
            js = js[(root[js] != root[i]) & (home[js] | home[i])]
            may = 100 * np.minimum(size[js], size[i]) >= percent * np.maximum(size[js], size[i])
            if shared is not None:
                may &= (100 + percent) * np.minimum(shared[js], shared[i]) >= percent * (size[js] + size[i])
            js = js[may]
            js = js[(signed[js] == signed[i]).sum(axis=1) >= MATCHES]
            if len(js):
                yield i, js


def _finder(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Nodes that collide often enough with a node of another component."""

    def find(table: pa.Table) -> pa.Table:
        found = np.zeros(len(table), bool)
        for i, js in _Block(table, percent).pairs():
            found[i] = found[js] = True
        return table.select(["node"]).filter(pa.array(found))

    return find


def _comparer(percent: int) -> Callable[[pa.Table], pa.Table]:
    """Confirmed links between the two blocks, one for each node and component it reaches."""

    def compare(table: pa.Table) -> pa.Table:
        node, root, shared = (table.column(c).to_numpy() for c in ("node", "root", "shared"))
        lists = table.column("shingles").combine_chunks()
        ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
        size = np.diff(ends)
        links = []
        for i, js in _Block(table, percent).pairs(shared):
            own = np.sort(flat[ends[i] : ends[i + 1]])
            theirs = np.concatenate([flat[ends[j] : ends[j + 1]] for j in js.tolist()])
            at = np.searchsorted(own, theirs).clip(max=len(own) - 1)
            starts = np.concatenate([[0], np.cumsum(size[js])[:-1]])
            common = np.add.reduceat(own[at] == theirs, starts, dtype=np.int64)
            js = js[100 * common >= percent * (size[js] + size[i] - common)]
            js = js[np.unique(root[js], return_index=True)[1]]
            links += [(node[i], j) for j in node[js]]
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"a": np.maximum(a, b), "b": np.minimum(a, b)})

    return compare


def _roots(links: DataFrame) -> DataFrame:
    return stored(components(links), "roots")


def near_groups(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept of every row.

    ``component_id`` is the smallest doc_id that can be reached over links, kept is whether
    it is the row's own (of texts of one doc_id in one component, one is kept).
    """
    signed = stored(
        docs.selectExpr("cast(doc_id as long) as doc_id", "text", f"{TEXT_HASH} as text_hash").mapInArrow(
            _signer(rule.words), _SIGNED
        ),
        "signatures",
    )
    named = signed.filter("n_shingles > 0 and doc_id is not null")
    nodes = stored(
        named.groupBy("node").agg(
            F.min("doc_id").alias("first"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
        ),
        "nodes",
    )
    prefixes = stored(_prefixes(nodes), "prefixes")
    members = stored(_by_hub(prefixes), "members")
    pairs = stored(_hub_pairs(members, nodes, rule), "hub-pairs")
    paired = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "paired")
    sets = _sets(docs, nodes, paired, rule)
    links = stored(_confirmed(pairs, sets, rule), "links")
    left = _open_members(members, nodes, _roots(links), rule)
    block = ["hub", "class", "low", "high"]
    signatures = nodes.select("node", "signature")
    close = _blocks(left, signatures).groupBy(*block).applyInArrow(_finder(rule.percent), "node long").distinct()
    close = stored(close, "close")
    near = sets.join(close, "node").union(_sets(docs, nodes, close.join(paired, "node", "left_anti"), rule))
    details = signatures.join(stored(_shared(near, rule.percent), "shared"), "node").join(near, "node")
    more = stored(
        _blocks(left.join(close, "node"), details)
        .groupBy(*block)
        .applyInArrow(_comparer(rule.percent), "a long, b long")
        .distinct(),
        "more-links",
    )
    roots = _roots(links.union(more))
    own = nodes.select("node", "first").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = own.groupBy("root").agg(F.min(F.struct("first", F.col("node").alias("keeper"))).alias("least"))
    by_node = own.join(stored(least, "least"), "root").select("node", "least.*")
    found = signed.join(stored(by_node, "by-node"), "node", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("first", "doc_id"))
    is_first = (F.col("doc_id") == component) & (F.col("node").isNull() | (F.col("node") == F.col("keeper")))
    return found.select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"),
        F.coalesce(is_first, F.lit(True)).alias("kept"),
    )


def keep_first(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """One document of each component, with all its columns; rows that repeat both id and text
    of that one all stay, because they are no different texts."""
    dropped = near_groups(docs, rule).filter(~F.col("kept")).select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    )
    dropped = stored(dropped, "dropped")
    keyed = docs.withColumn("__hash_here", F.expr(TEXT_HASH))
    same = (keyed["doc_id"] == dropped["__id"]) & (keyed["__hash_here"] == dropped["__hash"])
    return keyed.join(dropped, same, "left_anti").select(*docs.columns)


def _sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """Full sets of the wanted nodes, made again from the texts of one document of each.

    Texts that are not wanted are left out by a Bloom filter before anything moves; without one, beyond its
    bound, the join does that. Rows that repeat are dropped where they already lie together.
    """
    firsts = stored(nodes.select("node", F.col("first").alias("doc_id")).join(wanted, "node"), "wanted")
    texts = docs.selectExpr("cast(doc_id as long) as doc_id", "text", f"{TEXT_HASH} as text_hash")
    n = firsts.count()
    words = bloom_filter(firsts, "doc_id", n)
    if words is not None:
        texts = texts.filter(may_contain(words, F.col("doc_id"), n))
    once = texts.join(firsts, "doc_id").dropDuplicates(["doc_id", "node", "text_hash"]).select("node", "text")
    return stored(once.mapInArrow(_setter(rule.words), _SETS), "sets")
