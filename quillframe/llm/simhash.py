"""SimHash near-duplicates found by multi-index hashing.

A text's fingerprint is the majority vote, bit by bit, over the hashes of its
word shingles. Two fingerprints within ``max_bits`` differing bits are linked.
With the 64 bits cut into s segments, two such fingerprints differ in at most
``max_bits // s`` bits of one segment at least; each fingerprint therefore
probes the small Hamming ball of its value in every segment, fetches the
fingerprints whose segment has that value, and compares whole fingerprints.
Copies share a fingerprint and count once here, however many there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import extended, small_batches, written
from .components import components

SEED = 42
_CHUNK = 4096  # shingles whose bits are counted at once


def fingerprint(text: str | None, words: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a text.

    A-Z are lower-cased, words are runs without ASCII white space, shingles are
    ``words`` consecutive words joined by a space, repeats included; a shorter
    text is one shingle, and one without words (null, empty, blank) gives zero.
    """
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    n = max(1, len(tokens) - words + 1)
    starts, ends = starts[:n].tolist(), (ends[words - 1:] if n > 1 or len(tokens) == words else ends[-1:]).tolist()
    counts = np.zeros(64, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        hashes = np.array(
            [digest(joined[i:j - 1], SEED) for i, j in zip(starts[at:at + _CHUNK], ends[at:at + _CHUNK])], "<u8"
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id_col, fp long) of every row; the long holds the fingerprint's 64 bits."""
    small_batches(df.sparkSession)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter(
                (fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, batch.num_rows
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found.view(np.int64))], names=[id_col, "fp"]
            )

    return df.select(id_col, text_col).mapInArrow(of, extended(df, id_col, "fp long"))


def _segments(n: int) -> list[tuple[int, int]]:
    """(lowest bit, width) of n segments of 64 bits."""
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _keys(number: int, low: int, width: int, radius: int) -> list:
    """SQL of the probes of one segment: its value, then the values that set 1..radius of its zero bits."""
    tag = number << 40
    value = f"(shiftrightunsigned(fp, {low}) & {(1 << width) - 1}L)"
    rings = [f"array({value})"]
    grow = f"transform(sequence(0, {width - 1}), j -> shiftleft(1L, j))"
    if radius:
        rings.append(f"transform(filter({grow}, b -> ({value} & b) = 0), b -> {value} | b)")
    if radius > 1:
        raise ValueError("segments must be so many that a ball of radius 1 suffices")
    return [F.expr(f"transform({r}, x -> named_struct('key', {tag}L + x, 'exact', {str(i == 0).lower()}))") for i, r in enumerate(rings)]


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """Pairs (u, v) of different fingerprints within ``max_bits`` bits, each at least once.

    ``nodes`` has distinct fingerprints ``fp``. A pair that differs in one bit
    of a segment is met from its side that lacks the bit, so only those half
    balls are probed; the whole distance is tested as the join meets a match,
    before a row leaves it.
    """
    count = max_bits // 2 + 1
    parts = _segments(count)
    radius = max_bits // count
    probes = F.concat(*[k for i, (low, w) in enumerate(parts) for k in _keys(i, low, w, radius)])
    table = F.array(*[
        F.expr(f"{i << 40}L + (shiftrightunsigned(fp, {low}) & {(1 << w) - 1}L)") for i, (low, w) in enumerate(parts)
    ])
    a = nodes.select(F.col("fp").alias("u"), F.explode(probes).alias("p")).select("u", "p.key", "p.exact")
    b = nodes.select(F.col("fp").alias("v"), F.explode(table).alias("key"))
    near = (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits) & (~F.col("exact") | (F.col("u") < F.col("v")))
    return a.join(b, (a["key"] == b["key"]) & near).select("u", "v")


def simhash_components(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4
) -> DataFrame:
    """(id_col, fp, component_id) for every row: the smallest id reachable over links, its own included.

    Null or wordless texts have fingerprint zero and link like any other. Rows
    that repeat an id each get a row. A null id takes part but is never the
    smallest; a component without any id has a null ``component_id``. Other
    columns are ignored, and an empty table gives an empty one.
    """
    marked = written(fingerprints(df, id_col, text_col, words), "fingerprints")
    nodes = written(marked.groupBy("fp").agg(F.min(id_col).alias("rep")), "nodes")
    tied = components(links(nodes, max_bits)).withColumnRenamed("node", "fp")
    tied = written(tied, "tied")
    least = tied.join(nodes, "fp").groupBy("root").agg(F.min("rep").alias("least"))
    of_node = written(
        nodes.join(tied.join(least, "root").select("fp", "least", F.lit(True).alias("linked")), "fp", "left").select(
            "fp", F.when(F.col("linked"), F.col("least")).otherwise(F.col("rep")).alias("component_id")
        ),
        "of-node",
    )
    return marked.join(of_node, "fp").select(id_col, "fp", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4, max_bits: int = 4) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each component the row with the smallest id.

    Of rows that repeat that id one stays. Rows with a null id stay, as nothing names them.
    """
    found = written(simhash_components(df, id_col, text_col, words, max_bits), "components")
    dropped = found.where(F.col(id_col) != F.col("component_id")).select(id_col).distinct()
    again = found.where(F.col(id_col) == F.col("component_id")).groupBy(id_col).count().where("count > 1").select(id_col)
    again = written(again, "repeated")
    kept = df.join(dropped, id_col, "left_anti").select(df.columns)
    if again.isEmpty():
        return kept
    once = kept.join(again, id_col, "left_semi").select(df.columns).dropDuplicates([id_col])
    return kept.join(again, id_col, "left_anti").select(df.columns).unionByName(once)
