"""Vector code compression: product codes whose nearest entries are found by Orchard's search.

A vector's components become integers, the vector is cut into equal parts, and each part is
replaced by the index of the nearest entry in that part position's codebook. Codebooks are
refined in rounds of assigning parts and averaging them, in integers throughout, so that a
result does not depend on how the rows are partitioned.

Nearest entries are found without comparing a part with the whole codebook: every entry has a
list of all entries by distance from it. A search walks the list of its best entry so far, jumps
to the list of any entry that is nearer to the part, marks what it has compared, and stops where
the list goes beyond twice the best distance: by the triangle inequality nothing further on can
be as near. Entries at the same distance lie within that bound, so ties go to the lower index.

Each round is one pass over the rows in tasks that return sums per entry; only those sums and the
codebooks (``parts * entries`` of them) reach the driver. Vectors are never gathered.

Edge cases: a null vector and one with a null, NaN or infinite component is dropped. A null id is
kept and comes after all others when entries are chosen, rows that repeat an id by their components.
With fewer vectors than entries the codebooks are shorter, and an empty table gives no rows. A
null label is a label of its own. Vectors without components have equal codes and no error. All
vectors must have one length, a multiple of the parts, and integers below ``MOST`` in size, or
the run ends with a ValueError: other codes would not be comparable. Columns of the input other
than the id, the vector and the label are left out, so that none can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from orgtrail.llm.common import at_rest

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest size of an integer component: sums of squares of 16 and more stay in 64 bits.
MOST = 1 << 28
#: Vectors searched side by side in a task.
CHUNK = 2048
#: Parts of a label's rows when errors are joined back to it.
SALTS = 32


@dataclass(frozen=True)
class Codebook:
    """The entries of one part position, and each entry's neighbours by distance."""

    entries: np.ndarray
    order: np.ndarray
    apart: np.ndarray

    @staticmethod
    def of(entries: np.ndarray) -> Codebook:
        gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        order = np.argsort(gaps, axis=1, kind="stable")
        return Codebook(entries, order, np.take_along_axis(gaps, order, axis=1))

    def start(self, parts: np.ndarray) -> np.ndarray:
        """A first entry for each part: near it in the first component."""
        if not parts.shape[1]:
            return np.zeros(len(parts), dtype=np.int64)
        by_first = np.argsort(self.entries[:, 0], kind="stable")
        at = np.searchsorted(self.entries[by_first, 0], parts[:, 0])
        return by_first[np.minimum(at, len(by_first) - 1)]

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of the nearest entry and its squared distance, for each part.

        All searches take one step of their lists at a time; those that have stopped leave.
        """
        best = self.start(parts)
        error = ((parts - self.entries[best]) ** 2).sum(axis=1)
        marked = np.zeros((len(parts), len(self.entries)), dtype=bool)
        marked[np.arange(len(parts)), best] = True
        step = np.zeros(len(parts), dtype=np.int64)
        going = np.arange(len(parts))
        while going.size:
            going = going[step[going] < len(self.entries)]
            going = going[self.apart[best[going], step[going]] <= 4 * error[going]]
            found = self.order[best[going], step[going]]
            step[going] += 1
            new = ~marked[going, found]
            who, found = going[new], found[new]
            marked[who, found] = True
            distance = ((parts[who] - self.entries[found]) ** 2).sum(axis=1)
            better = (distance < error[who]) | ((distance == error[who]) & (found < best[who]))
            jumped = who[better]
            best[jumped], error[jumped], step[jumped] = found[better], distance[better], 0
        return best, error


def integer_vectors(df: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """The rows with usable vectors, as integers in ``_ints``."""
    x = F.col(vector)
    usable = x.isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    )
    ints = F.transform(x, lambda v: F.floor(v.cast("double") * scale).cast("long"))
    return df.filter(usable).withColumn("_ints", ints)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """The vectors of a batch as rows."""
    if not len(column):
        return np.empty((0, width), dtype=np.int64)
    lengths = np.diff(column.offsets.to_numpy())
    if (lengths != width).any():
        raise ValueError(f"vectors of {int(lengths[lengths != width][0])} and {width} components")
    found = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)
    if found.size and np.abs(found).max() > MOST:
        raise ValueError(f"a component is beyond {MOST} as an integer")
    return found


def _assigned(rows: np.ndarray, books: list[Codebook]) -> tuple[np.ndarray, np.ndarray]:
    """(rows, parts) indexes and squared distances."""
    wide = rows.shape[1] // len(books)
    codes = np.empty((len(rows), len(books)), dtype=np.int64)
    errors = np.empty_like(codes)
    for low in range(0, len(rows), CHUNK):
        some = slice(low, low + CHUNK)
        for p, book in enumerate(books):
            codes[some, p], errors[some, p] = book.nearest(rows[some, p * wide : (p + 1) * wide])
    return codes, errors


def _first_books(vectors: DataFrame, id_: str, parts: int, entries: int) -> np.ndarray | None:
    """Codebooks of the smallest ids as (parts, entries, width), None without vectors."""
    first = vectors.orderBy(F.col(id_).asc_nulls_last(), "_ints").select("_ints").limit(entries).collect()
    if not first:
        return None
    widths = {len(row[0]) for row in first}
    if len(widths) > 1 or min(widths) % parts:
        raise ValueError(f"vectors of {sorted(widths)} components do not make {parts} equal parts")
    return np.array([row[0] for row in first], dtype=np.int64).reshape(len(first), parts, -1).transpose(1, 0, 2)


def _refined(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks with each used entry at the floored mean of its parts."""
    n_parts, n_entries, wide = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [Codebook.of(b) for b in books]
        totals = np.zeros((n_parts, n_entries, wide + 1), dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch.column(0), n_parts * wide)
            codes, _ = _assigned(rows, made)
            for p in range(n_parts):
                np.add.at(totals[p, :, 1:], codes[:, p], rows[:, p * wide : (p + 1) * wide])
                totals[p, :, 0] += np.bincount(codes[:, p], minlength=n_entries)
        used = np.flatnonzero(np.repeat(totals[:, :, 0] > 0, wide + 1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int64()), pa.array(totals.reshape(-1)[used], pa.int64())], ["cell", "total"]
        )

    cells = vectors.select("_ints").mapInArrow(sums, "cell long, total long")
    totals = np.zeros(n_parts * n_entries * (wide + 1), dtype=np.int64)
    for row in cells.groupBy("cell").agg(F.sum("total").alias("total")).collect():
        totals[row["cell"]] = row["total"]
    totals = totals.reshape(n_parts, n_entries, wide + 1)
    count = totals[:, :, :1]
    return np.where(count > 0, np.floor_divide(totals[:, :, 1:], np.maximum(count, 1)), books)


def codebooks_digest(books: np.ndarray | None) -> str:
    """SHA-256 of all components by part, entry and position."""
    flat = [] if books is None else books.reshape(-1).tolist()
    return hashlib.sha256(",".join(map(str, flat)).encode()).hexdigest()


def fit_codebooks(
    df: DataFrame,
    id_: str = "vec_id",
    vector: str = "embedding",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
) -> np.ndarray | None:
    """Codebooks as integers (parts, entries, width); None if no vector is usable."""
    if not 1 <= entries <= 256:
        raise ValueError("entries must be 1 to 256: an index is written as two hex digits")
    vectors = integer_vectors(df.select(id_, vector), vector, scale)
    books = _first_books(vectors, id_, parts, entries)
    for _ in range(rounds if books is not None else 0):
        books = _refined(vectors, books)
    return books


def encode(
    df: DataFrame, books: np.ndarray | None, vector: str = "embedding", keep: tuple[str, ...] = ("vec_id", "label"), scale: int = SCALE
) -> DataFrame:
    """The usable rows' ``keep`` columns with ``code`` (hex) and ``error``."""
    vectors = integer_vectors(df.select(*keep, vector), vector, scale).select(*keep, "_ints")
    schema = StructType(
        [*vectors.drop("_ints").schema, StructField("code", StringType()), StructField("error", LongType())]
    )
    n_parts, wide = (PARTS, 0) if books is None else (books.shape[0], books.shape[2])

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [] if books is None else [Codebook.of(b) for b in books]
        for batch in batches:
            found, errors = _assigned(_matrix(batch.column(len(keep)), n_parts * wide), made)
            text = [row.tobytes().hex() for row in found.astype(np.uint8)]
            columns = [*batch.columns[: len(keep)], pa.array(text, pa.string()), pa.array(errors.sum(axis=1), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "code", "error"])

    return vectors.mapInArrow(codes, schema)


def decode(codes: DataFrame, books: np.ndarray, code: str = "code", scale: int = SCALE) -> DataFrame:
    """The rows with the approximate vector in ``decoded``: the entries that a code names."""
    schema = StructType([*codes.schema, StructField("decoded", ArrayType(LongType()))])
    at = codes.columns.index(code)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                None if text is None else np.concatenate([b[i] for b, i in zip(books, bytes.fromhex(text))]).tolist()
                for text in batch.column(at).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(rows, pa.list_(pa.int64()))], [*batch.schema.names, "decoded"]
            )

    made = codes.mapInArrow(vectors, schema)
    return made.withColumn("decoded", F.transform("decoded", lambda v: (v + F.lit(0.5)) / scale))


def with_label_errors(codes: DataFrame, label: str = "label", error: str = "error") -> DataFrame:
    """``label_error``: the errors of all rows with the same label.

    Sums are one row a label. A label may hold any share of the rows, so its rows are dealt to
    ``SALTS`` keys and its sum is copied to each of them.
    """
    sums = codes.groupBy(F.col(label).alias("_of")).agg(F.sum(error).alias("label_error"))
    sums = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = codes.withColumn("_salt", F.pmod(F.xxhash64(*codes.columns), F.lit(SALTS)).cast("int"))
    same = salted[label].eqNullSafe(sums["_of"]) & (salted["_salt"] == sums["_salt"])
    return salted.join(sums, same).select(*[salted[name] for name in codes.columns], "label_error")


def vector_code_report(df: DataFrame) -> DataFrame:
    """What the query returns."""
    books = fit_codebooks(df)
    codes = at_rest(encode(df, books), "vector-codes")
    return with_label_errors(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256")
    )


def _assignment_sql(books: str) -> str:
    return (
        f"select vec_id, rid, part, v, arg_min(entry, d * 64 + entry) as entry, min(d) as d from ("
        f"select p.vec_id, p.rid, p.part, p.v, b.entry, cast(list_sum([(p.v[i] - b.v[i]) * (p.v[i] - b.v[i]) "
        f"for i in range(1, len(p.v) + 1)]) as bigint) as d "
        f"from parts p join {books} b on p.part = b.part) x group by all"
    )


def _round_sql(books: str, assigned: str) -> str:
    return (
        f"select b.part, b.entry, coalesce(m.v, b.v) as v from {books} b left join ("
        f"select part, entry, list(cast(floor(s / n) as bigint) order by i) as v from ("
        f"select part, entry, i, cast(sum(v[i]) as double) as s, cast(count(*) as double) as n "
        f"from {assigned}, range(1, 5) t(i) group by part, entry, i) q group by part, entry) m using (part, entry)"
    )


#: For vectors of 64 components, of parts of 4.
ORACLE = f"""
with kept as (
  select vec_id, label, row_number() over (order by vec_id nulls last) as rid,
         [cast(floor(cast(x as double) * 256) as bigint) for x in embedding] as v
  from embeddings where embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
parts as (select vec_id, rid, cast(p as int) as part, v[p * 4 + 1 : p * 4 + 4] as v from kept, range(0, 16) t(p)),
b0 as (select part, rid - 1 as entry, v from parts where rid <= 64),
a0 as ({_assignment_sql('b0')}),
b1 as ({_round_sql('b0', 'a0')}),
a1 as ({_assignment_sql('b1')}),
b2 as ({_round_sql('b1', 'a1')}),
a2 as ({_assignment_sql('b2')}),
rows_ as (select rid, string_agg(format('{{:02x}}', entry), '' order by part) as code, cast(sum(d) as bigint) as error from a2 group by rid),
books as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as digest from b2)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, digest as codebooks_sha256
from rows_ join kept using (rid), books"""
