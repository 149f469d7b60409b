"""Vector code compression: a product quantiser in whole numbers, assigned by screened matrix products.

Components become floor(scale * x). A vector is cut into PARTS equal consecutive parts; each part position has a codebook of at most ENTRIES
entries, begun from the vectors of the smallest ids and moved in rounds to the floor of their parts' means. All of it is exact integer
arithmetic; only the search for the nearest entry is screened in float32: the distance of part x to entry c is |x|^2 - 2 x.c + |c|^2, of which
|x|^2 is the same for all entries, and x.c comes from one float32 matrix product a part. Its error is at most
  gamma(w + 2) * |x| * |c|,   gamma(n) = n u / (1 - n u), u = 2^-24, w the part's width,
in whatever order the products are summed: w roundings of a sum, one of each factor to float32 (Cauchy-Schwarz for the sum of absolute
products). That makes an interval around each entry's value; every entry whose interval reaches below the least upper end is computed again
in int64, and ties go to the lowest index. Parts too large for float32 or int64 are computed in Python's unbounded integers.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veriloom.llm.shared import cut, forget, join_spread

PARTS, ENTRIES, ROUNDS = 8, 16, 6
#: Magnitudes of components below which float32 products can't overflow, and squared distances of `width` components fit int64.
_UNIT = 2.0**-24
_FLOAT = 2.0**50
_LIMB = 1 << 32
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1
ROWS = 8192


def whole(values: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x), x as double: int64, or Python's integers where one doesn't fit."""
    y = np.floor(values.astype(np.float64) * scale)
    if np.abs(y).max(initial=0) < 2.0**62:
        return y.astype(np.int64)
    return np.array([int(v) for v in y.ravel()], object).reshape(y.shape)


def in_int64(magnitude: int, width: int) -> bool:
    """Whether squared distances between vectors of components up to `magnitude` fit int64."""
    return width * (2 * magnitude) ** 2 < 1 << 62


@dataclass
class Met:
    """What a search did: parts looked up, those that more than one entry's interval left open, entries computed again."""

    parts: int = 0
    open: int = 0
    again: int = 0


def intervals(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of |c|^2 - 2 x.c for each row of x and entry of c, both int64, in doubles."""
    u = _UNIT
    n = x.shape[1] + 2
    gamma = n * u / (1 - n * u)
    product = (x.astype(np.float32) @ c.astype(np.float32).T).astype(np.float64)
    length = lambda m: np.sqrt((m.astype(np.float64) ** 2).sum(1)) * (1 + 1e-12)  # noqa: E731  rounded up
    err = 2 * gamma * np.outer(length(x), length(c))
    square = (c * c).sum(1).astype(np.float64)
    middle = square - 2 * product
    err += 2.0**-50 * (square + 2 * np.abs(product)) + err * 1e-12  # what doubles round
    return middle - err, middle + err


def nearest(x: np.ndarray, c: np.ndarray, met: Met | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(index, exact squared distance) of each row's nearest entry; ties to the lowest index."""
    met = met or Met()
    met.parts += len(x)
    if not len(x):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    most = max((max(int(m.max()), -int(m.min())) if m.size else 0) for m in (x, c))
    if x.dtype == object or c.dtype == object or not in_int64(most, x.shape[1]) or most >= _FLOAT:
        d = ((x.astype(object)[:, None, :] - c.astype(object)[None]) ** 2).sum(2) if x.shape[1] else np.zeros((len(x), len(c)), object)
        met.again += d.size
        at = np.array([min(range(len(c)), key=lambda j: (r[j], j)) for r in d], np.int64)
        return at, d[np.arange(len(x)), at]
    low, high = intervals(x, c)
    row, entry = np.nonzero(low <= high.min(1)[:, None])  # ascending by row, then entry; the least upper end's own entry is among them
    d = ((x[row] - c[entry]) ** 2).sum(1)
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    sizes = np.diff(np.append(first, len(row)))
    met.open += int((sizes > 1).sum())
    met.again += int(sizes[sizes > 1].sum())
    least = np.minimum.reduceat(d, first)
    hit = np.flatnonzero(d == np.repeat(least, sizes))
    return entry[hit[np.searchsorted(row[hit], np.arange(len(x)))]], least


def _limbs(v: int, n: int) -> list[int]:
    """v in limbs of 32 bits, the last one signed, so that sums of limbs stay in a long."""
    out = []
    for _ in range(n - 1):
        out.append(v % _LIMB)
        v //= _LIMB
    return [*out, v]


def matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """Vectors as rows of whole numbers, shorter ones padded with zeros."""
    size = column.value_lengths().to_numpy()
    out = np.zeros((len(size), width))
    out[np.repeat(np.arange(len(size)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = column.flatten().to_numpy()
    return whole(out, scale)


class Codebooks:
    """books[p]: entries of part position p, as rows of int64, or Python's integers where one doesn't fit. No entry where there are no vectors."""

    def __init__(self, books: list[np.ndarray]):
        self.books = books
        self.part = books[0].shape[1] if books else 0

    @staticmethod
    def cut(rows: np.ndarray, parts: int) -> list[np.ndarray]:
        w = rows.shape[1] // parts
        return [rows[:, p * w : (p + 1) * w] for p in range(parts)]

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(v)) for b in self.books for v in b.ravel()).encode()).hexdigest()

    def assign(self, rows: np.ndarray, met: Met | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """(indexes as columns, exact distances a part)."""
        found = [nearest(x, c, met) for x, c in zip(self.cut(rows, len(self.books)), self.books, strict=True)]
        return np.stack([f[0] for f in found], 1), [f[1] for f in found]


def _sums(rows: np.ndarray, at: np.ndarray, parts: int, entries: int) -> tuple[np.ndarray, np.ndarray]:
    """(counts, sums) by part, entry (and component), exact."""
    w = rows.shape[1] // parts
    count = np.zeros((parts, entries), np.int64)
    total = np.zeros((parts, entries, w), rows.dtype)
    for p in range(parts):
        order = np.argsort(at[:, p], kind="stable")
        key = at[order, p]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        count[p, key[first]] = np.diff(np.append(first, len(key)))
        if w:
            total[p, key[first]] = np.add.reduceat(rows[order, p * w : (p + 1) * w], first, axis=0)
    return count, total


def usable(vectors: DataFrame, vec_col: str) -> DataFrame:
    """Rows whose vector is not null and holds only finite numbers."""
    finite = F.forall(F.col(vec_col), lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vectors.where(F.coalesce(F.col(vec_col).isNotNull() & finite, F.lit(False)))


def fit(table: DataFrame, width: int, scale: float, most: float, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of table(id, v): read once a round; what reaches the driver is entries * width sums, whatever the table's rows. most: the largest |component|."""
    spark = table.sparkSession
    first = table.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).select("v").toArrow().combine_chunks()
    rows = matrix(first["v"].combine_chunks(), width, scale) if first.num_rows else np.zeros((0, width), np.int64)
    books = Codebooks(Codebooks.cut(rows, parts))
    n = len(rows)
    if not n:
        return books
    w = width // parts
    # |sum| < rows * 2**bits: the last limb is signed, and below 2**31 tasks' sums of any limb fit a long
    limbs = max(2, -(-(max(1, int(most)).bit_length() + 24) // 32))

    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)

        def run(batches, shared=shared):
            count, total = np.zeros((parts, n), object), np.zeros((parts, n, w), object)
            for b in batches:
                for lo in range(0, b.num_rows, ROWS):
                    x = matrix(b.column(0).slice(lo, ROWS), width, scale)
                    k, t = _sums(x if int(np.abs(x).max(initial=0)) < 1 << 48 else x.astype(object), shared.value.assign(x)[0], parts, n)
                    count, total = count + k, total + t
            flat = np.concatenate([count.reshape(parts, n, 1), total], 2).ravel()
            at = np.flatnonzero(flat != 0)
            pieces = np.array([_limbs(int(v), limbs) for v in flat[at]], np.int64).reshape(-1, limbs)
            slot = np.repeat(at, limbs) * limbs + np.tile(np.arange(limbs), len(at))
            yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int64)), pa.array(pieces.ravel())], names=["slot", "n"])

        got = table.select("v").mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
        flat = np.zeros(parts * n * (w + 1), object)
        for slot, v in zip(got["slot"].to_pylist(), got["n"].to_pylist(), strict=True):
            flat[slot // limbs] += v << 32 * (slot % limbs)
        flat = flat.reshape(parts, n, w + 1)
        moved = []
        for p in range(parts):
            rows = [[s // c[0] for s in c[1:]] if c[0] else [int(v) for v in old] for c, old in zip(flat[p].tolist(), books.books[p], strict=True)]
            fits = all(abs(v) < 1 << 62 for r in rows for v in r)
            moved.append(np.array(rows, np.int64 if fits else object).reshape(n, w))
        shared.unpersist()
        books = Codebooks(moved)
    return books


def compress(vectors: DataFrame, scale: float = 4096.0, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id_col, code, error, label_error, codebooks_sha256) of every vector that is neither null nor holds null or non-finite components.

    code: two hex digits an index, in part order. error: squared distances to the assigned entries, summed over parts; label_error: error summed over
    rows of equal label, nulls together; both cut to the range of a long. Codebooks begin with the `entries` smallest ids (null ids last, rows that repeat
    an id by their vectors), fewer where there are fewer rows; unused entries stay. Rows with a null id or label and repeated rows take part and
    are returned. Vectors are padded with zeros to the longest's length, rounded up to a multiple of `parts`. Other columns are ignored; an empty table gives none.
    No vector is shuffled but the first `entries`; sums by entry and label are combined before they are. entries: at most 256, two hex digits.
    """
    spark = vectors.sparkSession
    label = F.col(label_col).cast("string")
    kept = usable(vectors, vec_col).select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v"), F.coalesce(label, F.lit("")).alias("label"), label.isNull().alias("none"))
    table = cut(kept, "parts")
    biggest = F.aggregate("v", F.lit(0.0), lambda a, x: F.greatest(a, F.abs(x)))
    longest, most = table.agg(F.max(F.size("v")), F.max(biggest)).first()
    width = -(-(longest or 0) // parts) * parts
    most = min((most or 0.0) * scale + 1, 1.7e308)
    books = fit(table, width, scale, most, parts, entries, rounds)
    shared = spark.sparkContext.broadcast(books)

    def run(batches):
        c = shared.value
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                at, d = c.assign(matrix(part.column(1), width, scale))
                total = np.zeros(len(at), object)
                for x in d:
                    total = total + x
                error = pa.array([min(int(e), _MOST) for e in total], pa.int64())
                code = pa.array([bytes(r).hex() for r in at.astype(np.uint8).tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), code, error, part.column(2), part.column(3)], names=["id", "code", "error", "label", "none"])

    kind = table.schema["id"].dataType.simpleString()
    coded = cut(table.mapInArrow(run, f"id {kind}, code string, error long, label string, none boolean"), "codes")
    forget(table)
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    sums = coded.groupBy("label", "none").agg(F.least(total, F.lit(_MOST).cast("decimal(38,0)")).cast("long").alias("label_error"), F.count("*").alias("rows"))
    out = join_spread(coded, cut(sums, "labels"), ["label", "none"], "rows")
    return out.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))
