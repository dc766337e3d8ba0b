"""SimHash near-duplicates: fingerprints, Gray-order index, connected components.

Fingerprints are made per row, in Arrow batches.  From there on only distinct
fingerprints move: they are linked by :mod:`gray_index` and joined into
components by :mod:`components`; a component's id is its smallest doc_id.

Defined cases: a null, empty or wordless text has fingerprint 0 and is linked
like any other; fewer words than a shingle make one shingle of all of them;
repeated rows come out as often as they went in; a null doc_id keeps its row,
and never names a component that holds another id.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from .common import NO_ID, column, text_of
from .components import components
from .gray_index import links

SEED = 42
_STEP = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: str, shingle: int = 3) -> int:
    """64 bits, each set if it is set in over half of the shingles' hashes."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space alone
    if not words:
        return 0
    if len(words) < shingle:
        parts: Iterator = iter([words])
        n = 1
    else:
        parts = zip(*[words[i:] for i in range(shingle)], strict=False)
        n = len(words) - shingle + 1
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, parts), repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _STEP):
        part = hashes[at:at + _STEP].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = np.fromiter((fingerprint(t.as_py() or "", shingle) for t in batch.column(2)),
                            np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes.view(np.int64))],
                                         ["doc_id", "th", "code"])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, th, code): the id, the hash of the text and the fingerprint (a signed long) of every row."""
    rows = docs.select(docs["doc_id"].cast("bigint"), F.xxhash64(text_of(docs)).alias("th"), docs["text"].cast("string"))
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id long, th long, code long")


def _grouped(prints: DataFrame, max_bits: int) -> DataFrame:
    """(code, root, first_id): the distinct fingerprints, each with its component's smallest one."""
    codes = prints.groupBy("code").agg(F.min("doc_id").alias("first_id")).checkpoint()
    roots = components(links(codes.select("code"), max_bits))
    return codes.join(roots, codes["code"] == roots["node"], "left").select(
        "code", "first_id", F.coalesce("root", "code").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id."""
    prints = fingerprints(docs, shingle).checkpoint()
    placed = _grouped(prints, max_bits)
    lowest = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = placed.join(lowest, "root").select(F.col("code").alias("of_code"), "component_id")
    return prints.join(named, prints["code"] == named["of_code"], "left").select(
        "doc_id", F.lpad(F.lower(F.hex("code")), 16, "0").alias("fingerprint"), "component_id")


def keep_representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of ``docs`` for each component: that of the smallest doc_id, null last.

    Of rows that share that id the one whose text has the smallest hash stays, and of rows equal in
    both the one whose columns have the smallest hash, so the choice does not depend on the order of tasks.
    """
    prints = fingerprints(docs, shingle).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("doc_id"), "th", "code").checkpoint()
    placed = _grouped(prints, max_bits).select(F.col("code").alias("of_code"), "root")
    first = prints.join(placed, F.col("code") == F.col("of_code")).groupBy("root").agg(
        F.min(F.struct("doc_id", "th")).alias("row")).select(F.col("row.doc_id").alias("row_id"), F.col("row.th").alias("row_th"))
    same = ((F.coalesce(docs["doc_id"].cast("bigint"), F.lit(NO_ID)) == first["row_id"])
            & (F.xxhash64(text_of(docs)) == first["row_th"]))
    rows = docs.join(first, same)
    whole = F.xxhash64(*[column(docs, f.name) for f in docs.schema.fields if not isinstance(f.dataType, MapType)])
    nth = F.row_number().over(Window.partitionBy(first["row_id"], first["row_th"]).orderBy(whole))
    return rows.select(*[column(docs, c) for c in docs.columns], nth.alias("nth of its kind")).where(F.col("`nth of its kind`") == 1).drop("nth of its kind")
