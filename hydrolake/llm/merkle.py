"""Merkle manifest of a dataset, with a witness for every row, by streaming aligned appends.

A leaf is the SHA-256 of a row's fields.  Within a tree (a source) the leaves stand by doc_id and every 16
consecutive nodes (the last run may be shorter) become one node, until one is left: the tree's root.  The
roots of the sources, by source, null first, are the leaves of a last tree, whose root is the dataset's.

1. ``ranks.positions`` gives each leaf its place in its tree; a hot source is spread over all tasks.
2. Leaves come in aligned blocks of 16^3, each appended one by one in one task (``Block``).  A new node
   gets the earlier siblings of its open run as a partial witness, and every later sibling that completes
   extends the witnesses of the open nodes before it.  A full run closes and its node is appended one level up.
3. The roots of the blocks are appended in the next round like leaves, and so on until each tree has one node;
   the sources' roots then go through the same rounds.
4. From the top down, the witness of a block extends those of the nodes appended to it.  It comes to the block's
   task as the first row of its stream, so no row of the join carries it.

Only 32-byte digests are shuffled; texts are hashed where they are read.  A task holds one block.

A null field is written ``-``, any other as its UTF-8 byte count, ``:`` and the value.  Rows of one source with
equal doc_id stand by their leaf (null doc_id first), so repeated rows have defined places; null and
empty sources are two trees.  An empty table gives an empty result.  Of extra columns none is read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType

from .common import cut
from .mixing import source_key
from .ranks import positions

ARITY = 16
#: A round appends nodes in blocks of this many levels.
BLOCK_LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64       # characters of a digest as text


def digest(joined: bytes) -> bytes:
    """The hash of joined inputs, as lowercase hex."""
    return hashlib.sha256(joined).hexdigest().encode()


class Node:
    """A node of an open tree, with the witness that it has so far."""

    __slots__ = ("hash", "witness", "parent")

    def __init__(self, value: bytes):
        self.hash, self.witness, self.parent = value, bytearray(), None

    def path(self) -> bytes:
        """The siblings from here to the block's root, level by level, left to right."""
        out, node = b"", self
        while node is not None:
            out, node = out + node.witness, node.parent
        return out


class Block:
    """An aligned block of a tree that takes one node after the other."""

    def __init__(self, levels: int):
        self.levels, self.open, self.root = levels, [[] for _ in range(levels)], None

    def append(self, value: bytes, level: int = 0) -> Node:
        node = Node(value)
        if level == self.levels:
            self.root = value
            return node
        run = self.open[level]
        for earlier in run:
            node.witness += earlier.hash
            earlier.witness += value
        run.append(node)
        if len(run) == ARITY:
            self.close(level)
        return node

    def close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        if run:
            parent = self.append(digest(b"".join(n.hash for n in run)), level + 1)
            for n in run:
                n.parent = parent

    def finish(self) -> bytes:
        """Close the runs that are still open; the block's root."""
        for level in range(self.levels):
            self.close(level)
        return self.root


def levels_of(n: int, most: int) -> int:
    """How many levels, of ``most``, a round builds on a tree of ``n`` nodes."""
    return sum(ARITY ** k < n for k in range(most))


def fold(value: bytes, witness: bytes, places: Iterable[tuple[int, int]]) -> bytes:
    """The root that a leaf and its siblings give; ``places``: its place and the number of nodes, tree by tree."""
    at = 0
    for pos, n in places:
        while n > 1:
            i = pos % ARITY
            size = min(ARITY, n - (pos - i))
            own, end = at + i * _HEX, at + (size - 1) * _HEX
            value = digest(witness[at:own] + value + witness[own:end])
            at, pos, n = end, pos // ARITY, -(-n // ARITY)
    return value


def leaf(text: Column | str = "text") -> Column:
    """A row's hash, with ``text`` in the place of its text."""
    parts = []
    for c in FIELDS:
        value = (text if isinstance(text, Column) else F.col(text)) if c == "text" else F.col(c)
        value = value.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def tampered_text() -> Column:
    """The text with A-Z in lower case where 5 divides the CRC-32 of the doc_id."""
    low = F.translate(F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, low).otherwise(F.col("text"))


_NODE = "_tree string, _pos long, _n long, _hash binary"


def _in_blocks(nodes: DataFrame) -> DataFrame:
    """The rows block by block, each block in one task, in order."""
    return (nodes.withColumn("_block", F.when(F.col("_pos") < 0, F.col("_above")).otherwise(F.expr(f"_pos div {ARITY ** BLOCK_LEVELS}")))
            .repartition("_tree", "_block").sortWithinPartitions("_tree", "_block", "_pos"))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[dict]]]:
    """(tree, block) and its rows, one block at a time."""
    key, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            this = row["_tree"], row["_block"]
            if this != key:
                if rows:
                    yield key, rows
                key, rows = this, []
            rows.append(row)
    if rows:
        yield key, rows


def _block_roots(nodes: DataFrame) -> DataFrame:
    """The next round's nodes: the root of every block."""
    most = BLOCK_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for (tree, block), rows in _blocks(batches):
            n = rows[0]["_n"]
            levels = levels_of(n, most)
            appended = Block(levels)
            for row in rows:
                appended.append(row["_hash"].hex().encode())
            out.append((tree, block, -(-n // ARITY ** levels), bytes.fromhex(appended.finish().decode())))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), (pa.string(), pa.int64(), pa.int64(), pa.binary()))],
                                             ["_tree", "_pos", "_n", "_hash"])

    ranked = nodes.select("_tree", "_pos", "_n", "_hash", F.lit(None).cast("long").alias("_above"))
    return _in_blocks(ranked).select("_tree", "_block", "_n", "_hash").mapInArrow(run, _NODE)


def rounds(nodes: DataFrame) -> list[DataFrame]:
    """The nodes of every round, from the leaves (_tree, _pos, _n, _hash) to one node a tree."""
    layers = [nodes]
    while (layers[-1].agg(F.max("_n").alias("n")).first().n or 0) > 1:
        layers.append(cut(_block_roots(layers[-1])))
    return layers


def _with_witness(nodes: DataFrame, above: DataFrame, told: dict[str, str], emit: Callable, schema: StructType) -> DataFrame:
    """Append the nodes block by block again, extend their witnesses by that of their block, and give
    ``emit(node's row, witness, block's row)`` for each.

    ``above``: _tree, _pos (the block), _witness and the ``told`` columns.
    """
    extra = {f.name: f.dataType for f in nodes.schema if f.name not in ("_tree", "_pos", "_n", "_hash")}
    null = lambda kind: F.lit(None).cast(kind)
    below = nodes.select("_tree", "_pos", "_n", "_hash", null("long").alias("_above"), null("binary").alias("_witness"),
                         *[null(k).alias(c) for c, k in told.items()], *extra)
    head = above.select("_tree", F.lit(-1).cast("long").alias("_pos"), null("long").alias("_n"), null("binary").alias("_hash"),
                        F.col("_pos").alias("_above"), "_witness", *told, *[null(k).alias(c) for c, k in extra.items()])
    arrow, most = to_arrow_schema(schema), BLOCK_LEVELS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (first, *rest) in _blocks(batches):
            if not rest:        # an empty table has a start and no nodes
                continue
            block = Block(levels_of(rest[0]["_n"], most))
            appended = [block.append(row["_hash"].hex().encode()) for row in rest]
            block.finish()
            end = first["_witness"].hex().encode()
            shared: dict[int, bytes] = {}       # siblings of a run share the way up from their parent
            out = []
            for row, node in zip(rest, appended):
                tail = shared.get(id(node.parent))
                if tail is None:
                    tail = shared[id(node.parent)] = (node.parent.path() if node.parent else b"") + end
                out.append(emit(row, bytes(node.witness) + tail, first))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), arrow.types)], arrow.names)

    return _in_blocks(below.unionByName(head)).mapInArrow(run, schema)


def _block_witnesses(layers: list[DataFrame], above: DataFrame, told: dict[str, str]) -> DataFrame:
    """The witnesses of the blocks that the leaves are appended to, from those of the trees' roots."""
    schema = StructType.fromDDL(", ".join(["_tree string, _pos long, _witness binary", *(f"{c} {k}" for c, k in told.items())]))

    def emit(row: dict, witness: bytes, first: dict) -> tuple:
        return row["_tree"], row["_pos"], bytes.fromhex(witness.decode()), *[first[c] for c in told]

    for layer in reversed(layers[1:-1]):
        above = cut(_with_witness(layer, above, told, emit, schema))
    return above


def verify(docs: DataFrame, altered_text: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``altered_text``: what the row's text reads when it is checked (by default as it is).  That leaf is folded with
    the original siblings; ``verified`` tells if it gives the root.  ``proof_sha256`` is the hash of the siblings.
    """
    spark = docs.sparkSession
    rows = cut(docs.select("doc_id", source_key(F.col("source")).alias("_tree"), F.unhex(leaf()).alias("_hash"),
                           F.unhex(leaf() if altered_text is None else leaf(altered_text)).alias("_altered"),
                           F.monotonically_increasing_id().alias("_read")))
    leaves = cut(positions(rows, ["_tree"], ["doc_id", "_hash", "_read"]).select("_tree", "_pos", "_n", "_hash", "_altered", "doc_id"))
    layers = rounds(leaves)
    subroots = layers[-1].select(F.col("_tree").alias("_of"), "_hash")
    sources = cut(positions(subroots, [], ["_of"]).select(F.lit("").alias("_tree"), "_pos", "_n", "_hash", "_of"))
    top = rounds(sources)
    last = top[-1].first()          # the one node of the last tree, or none of an empty table
    root = last._hash.hex() if last else ""

    # from the root down: the sources, then the blocks of each source, then the leaves
    start = spark.range(1).select(F.lit("").alias("_tree"), F.lit(0).cast("long").alias("_pos"), F.lit(bytearray()).alias("_witness"))
    told = {"_subroot": "binary", "_rank": "long", "_sources": "long"}
    schema = StructType.fromDDL("_tree string, _pos long, _witness binary, _subroot binary, _rank long, _sources long")
    of_source = cut(_with_witness(sources, _block_witnesses(top, start, {}), {}, lambda row, witness, first: (
        row["_of"], 0, bytes.fromhex(witness.decode()), row["_hash"], row["_pos"], row["_n"]), schema))

    def emit(row: dict, witness: bytes, first: dict) -> tuple:
        folded = fold(row["_altered"].hex().encode(), witness, [(row["_pos"], row["_n"]), (first["_rank"], first["_sources"])]).decode()
        return (row["doc_id"], row["_hash"].hex(), first["_subroot"].hex(), root, digest(witness).decode(), folded, folded == root)

    result = StructType([StructField("doc_id", docs.schema["doc_id"].dataType), *StructType.fromDDL(
        "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean").fields])
    return _with_witness(leaves, _block_witnesses(layers, of_source, told), told, emit, result)
