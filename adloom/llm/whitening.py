"""Whiten embeddings on their leading principal components, found by Jacobi-Davidson.

The covariance is never formed.  All that is asked of the vectors is its product with a narrow
block of directions: every task centres its vectors, multiplies them with the block and back, and
sums; the sums of many tasks are added up in a second stage, so that the driver receives few.

Around these products runs a block Jacobi-Davidson iteration.  A search space holds trial
directions; a Rayleigh-Ritz step picks from it the pairs nearest to eigenpairs.  For each wanted
pair that is not exact yet, the correction equation, projected off that pair, its fellows and the
locked ones, is solved roughly by a few steps of MINRES; all pairs take their steps together, one
distributed product for all.  The corrections widen the search space.  A pair whose residual is
down to rounding is locked: it stays as it is, and the rest is kept orthogonal to it.  A search
space that has grown too wide shrinks to its best Ritz vectors.

Entries are first made whole numbers ``floor(scale * c) + shift``.  Sums are exact; a centred entry
is a whole number less a proper fraction, so it is rounded once.

Defined cases: rows whose vector is null, empty, or holds null, non-finite or absurdly large
entries (from 2 ** 52 on, which have no 64-bit whole number) are left out; rows with equal or null
ids are rows each; vectors of each length are a fit of their own, one after the other.  Components
without variance cannot be whitened and give no rows: one vector alone, or equal ones, give none,
vectors of few dimensions give as many as they have.  A deviation beyond 64 bits is null.  Of the
two signs of a component the one is taken that makes its largest entry positive.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import column, saved
from adloom.session import MIB, input_bytes

# Sums of tasks are added up in so many groups before the driver adds the rest.
GROUPS = 64

# Bytes of vectors in a file that the products read, so that they don't open many small files.
FILE_BYTES = 32 * MIB
MOST_FILES = 100_000

# Digits of whole numbers are summed in two parts, so that 64 bits hold the sums.
LOW_BITS = 31

Product = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class WhiteningRule:
    components: int = 8
    scale: int = 1024
    shift: int = 100_000
    # Residuals, as parts of the largest eigenvalue and per root of the dimension.
    tolerance: float = 1e-14
    # Directions searched beyond those wanted.
    spare: int = 8
    # MINRES steps for a correction, and the part of its residual that may be left.
    inner_steps: int = 2
    inner_left: float = 0.05
    # The search space shrinks when it is so many times as wide as at the start.
    widest: int = 8
    most_rounds: int = 300
    seed: int = 13


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` vectors, their sums as ``n * whole + rest``, and the components as columns."""

    n: int
    whole: np.ndarray
    rest: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float = 0.0

    def centred(self, entries: np.ndarray) -> np.ndarray:
        return (entries - self.whole).astype(np.float64) - self.rest / self.n

    def deviations(self, entries: np.ndarray) -> list[int | None]:
        """Per vector the sum of ``(n * x - S) ** 2``, exactly."""
        apart = entries - self.whole
        most = self.n * (int(np.abs(apart).max(initial=0)) + 1)
        if entries.shape[1] * most**2 < 2**63:
            return np.square(self.n * apart - self.rest).sum(axis=1).tolist()
        exact = np.square(self.n * apart.astype(object) - self.rest.astype(object)).sum(axis=1)
        return [value if value < 2**63 else None for value in exact]

    @property
    def projection(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def whole_entries(frame: DataFrame, rule: WhiteningRule) -> DataFrame:
    """Rows ``vec_id, length, entries``: the vectors that count, as bytes of whole numbers."""

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            values = lists.values.cast(pa.float64())
            numbers = np.nan_to_num(values.to_numpy(zero_copy_only=False), nan=np.inf)
            wrong = ~(np.abs(numbers) < 2.0**52)
            before = np.concatenate(([0], np.cumsum(wrong)))
            lengths = np.diff(offsets)
            fine = lists.is_valid().to_numpy(zero_copy_only=False) & (lengths > 0)
            fine &= before[offsets[1:]] == before[offsets[:-1]]
            at = np.zeros(len(numbers) + 1, np.int64)
            np.add.at(at, offsets[:-1][fine], 1)
            np.add.at(at, offsets[1:][fine], -1)
            kept = numbers[np.cumsum(at[:-1]) > 0]
            entries = np.floor(kept * rule.scale).astype(np.int64) + rule.shift
            ends = np.concatenate(([0], np.cumsum(8 * lengths[fine])))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").filter(pa.array(fine)),
                    pa.array(lengths[fine].astype(np.int32)),
                    pa.Array.from_buffers(
                        pa.binary(),
                        int(fine.sum()),
                        [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(entries)],
                    ),
                ],
                ["vec_id", "length", "entries"],
            )

    return frame.mapInArrow(convert, "vec_id bigint, length int, entries binary")


def _matrix(entries: pa.Array) -> np.ndarray:
    """The vectors of a batch as rows; all have one length."""
    raw = entries.to_pylist()
    return np.frombuffer(b"".join(raw), np.int64).reshape(len(raw), -1)


def distributed_sum(
    rows: DataFrame, part: Callable[[np.ndarray], np.ndarray], tasks: int | None = None
) -> np.ndarray:
    """The sum of what ``part`` makes of all vectors, some at a time.

    Tasks' sums are added in order of their numbers, so that a repeated run rounds alike.  The
    driver receives no more than ``GROUPS`` of them: if there are more tasks, a second stage adds
    them up in so many groups.
    """
    if tasks is None:
        tasks = rows.rdd.getNumPartitions()

    def sum_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            if batch.num_rows:
                found = part(_matrix(batch.column("entries")))
                own = found if own is None else own + found
        if own is not None:
            number = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int32()),
                    pa.array([number % GROUPS], pa.int32()),
                    pa.array([own.dtype.str]),
                    pa.array([own.tobytes()], pa.binary()),
                ],
                ["task", "group", "kind", "numbers"],
            )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        kind = ""
        for batch in batches:
            for _, group, kind, raw in zip(*(c.to_pylist() for c in batch.columns)):
                numbers = np.frombuffer(raw, kind)
                totals[group] = totals[group] + numbers if group in totals else numbers
        for group, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([0], pa.int32()),
                    pa.array([group], pa.int32()),
                    pa.array([kind]),
                    pa.array([total.tobytes()], pa.binary()),
                ],
                ["task", "group", "kind", "numbers"],
            )

    schema = "task int, group int, kind string, numbers binary"
    sums = rows.select("entries").mapInArrow(sum_task, schema)
    if tasks > GROUPS:
        in_order = sums.repartition("group").sortWithinPartitions("group", "task")
        sums = in_order.mapInArrow(add, schema)
    found = sorted(sums.collect(), key=lambda r: (r.task, r.group))
    return reduce(np.add, (np.frombuffer(r.numbers, r.kind) for r in found))


def column_sums(rows: DataFrame, tasks: int | None = None) -> list[int]:
    """The exact sum of each entry over all vectors."""

    def of(entries: np.ndarray) -> np.ndarray:
        low = entries & ((1 << LOW_BITS) - 1)
        return np.concatenate(((entries >> LOW_BITS).sum(axis=0), low.sum(axis=0)))

    high, low = distributed_sum(rows, of, tasks).reshape(2, -1).tolist()
    return [(h << LOW_BITS) + part for h, part in zip(high, low)]


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Unit directions that a block adds to others; what adds next to nothing is left out."""
    found = np.zeros((len(block), 0))
    for direction in block.T:
        size = np.linalg.norm(direction)
        if not size:
            continue
        direction = direction / size
        for _ in range(2):
            for basis in (*against, found):
                direction = direction - basis @ (basis.T @ direction)
            left = np.linalg.norm(direction)
            if left < 1e-8:
                break
            direction = direction / left
        else:
            found = np.column_stack((found, direction))
    return found


def minres(apply: Product, right: np.ndarray, steps: int, left: float) -> np.ndarray:
    """Solve ``apply(x) = right`` roughly, each column a symmetric system of its own.

    All columns take a step together, so one block product serves them all.
    """

    def over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.divide(a, b, out=np.zeros(np.broadcast(a, b).shape), where=b > 0)

    size = np.linalg.norm(right, axis=0)
    vector, before = over(right, size), np.zeros_like(right)
    step, step_before, solution = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    cosine, cosine_before = np.ones_like(size), np.ones_like(size)
    sine, sine_before = np.zeros_like(size), np.zeros_like(size)
    beta, rest = size, size
    for _ in range(steps):
        image = apply(vector)
        alpha = (vector * image).sum(axis=0)
        image = image - alpha * vector - beta * before
        following = np.linalg.norm(image, axis=0)
        first = cosine * alpha - cosine_before * sine * beta
        length = np.hypot(first, following)
        second = sine * alpha + cosine_before * cosine * beta
        third = sine_before * beta
        new = over(vector - third * step_before - second * step, length)
        cosine_before, sine_before = cosine, sine
        cosine, sine = over(first, length), over(following, length)
        solution = solution + cosine * rest * new
        rest = -sine * rest
        step_before, step = step, new
        before, vector, beta = vector, over(image, following), following
        if (np.abs(rest) <= left * size).all():
            break
    return solution


def leading_pairs(
    product: Product, dimension: int, rule: WhiteningRule
) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric product, falling, and unit eigenvectors as columns."""
    random = np.random.default_rng([rule.seed, dimension])
    wanted = min(rule.components, dimension)
    width = min(dimension, wanted + rule.spare)
    tolerance = rule.tolerance * np.sqrt(dimension)
    locked = np.zeros((dimension, 0))
    largest = 0.0
    space = _orthonormal(random.normal(size=(dimension, width)))
    images = product(space)
    for _ in range(rule.most_rounds):
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, images = space @ turn, images @ turn
        largest = max(largest, float(np.abs(values).max()))
        residuals = images - space * values
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        whole = space.shape[1] + locked.shape[1] == dimension
        missing = wanted - locked.shape[1]
        exact = 0
        while exact < missing and (whole or sizes[exact] <= tolerance * largest):
            exact += 1
        locked = np.column_stack((locked, space[:, :exact]))
        if exact == missing:
            break
        space, images, values = space[:, exact:], images[:, exact:], values[exact:]
        residuals, sizes = residuals[:, exact:], sizes[exact:]
        missing -= exact
        if space.shape[1] + missing > rule.widest * width:
            space, images = space[:, : missing + rule.spare], images[:, : missing + rule.spare]
        open_ones = np.flatnonzero(sizes[:missing] > tolerance * largest)
        fixed = np.column_stack((locked, space[:, :missing]))
        shifts = values[open_ones]

        def projected(block: np.ndarray) -> np.ndarray:
            return block - fixed @ (fixed.T @ block)

        def corrected(block: np.ndarray) -> np.ndarray:
            block = projected(block)
            return projected(product(block) - block * shifts)

        right = -projected(residuals[:, open_ones])
        corrections = minres(corrected, right, rule.inner_steps, rule.inner_left)
        added = _orthonormal(corrections, locked, space)
        if not added.shape[1]:
            added = _orthonormal(random.normal(size=(dimension, missing)), locked, space)
        space, images = np.column_stack((space, added)), np.column_stack((images, product(added)))
    else:
        raise RuntimeError(f"no {wanted} eigenpairs after {rule.most_rounds} rounds")
    # One more step among the locked ones, whose order and angles are settled by exact products.
    locked = np.linalg.qr(locked)[0]
    small = locked.T @ product(locked)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = locked @ turn[:, ::-1]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(wanted)])
    return values[::-1], vectors * signs


def fit(rows: DataFrame, n: int, rule: WhiteningRule) -> Whitening:
    """The whitening of all vectors, which have one length, as ``whole_entries`` gives them."""
    tasks = rows.rdd.getNumPartitions()
    sums = column_sums(rows, tasks)
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)
    dimension = len(sums)
    centre = Whitening(n, whole, rest, np.zeros((dimension, 0)), np.zeros(0), 0.0).centred

    def product(block: np.ndarray) -> np.ndarray:
        def of(entries: np.ndarray) -> np.ndarray:
            apart = centre(entries)
            return (apart.T @ (apart @ block)).ravel()

        return distributed_sum(rows, of, tasks).reshape(block.shape) / n

    def squares(entries: np.ndarray) -> np.ndarray:
        return np.square(centre(entries)).sum(keepdims=True).ravel()

    trace = float(distributed_sum(rows, squares, tasks)[0]) / n
    values, vectors = leading_pairs(product, dimension, rule)
    varied = values > dimension * np.finfo(np.float64).eps * max(trace, 0.0)
    found = Whitening(n, whole, rest, vectors[:, varied], values[varied], trace)
    return Whitening(
        n, whole, rest, found.components, found.eigenvalues, trace, _identity_error(rows, found)
    )


def _identity_error(rows: DataFrame, found: Whitening) -> float:
    """How far the covariance of the whitened vectors is from the identity, at its worst entry."""
    projection, size = found.projection, len(found.eigenvalues)
    if not size:
        return 0.0

    def sums(entries: np.ndarray) -> np.ndarray:
        return (found.centred(entries) @ projection).sum(axis=0)

    mean = distributed_sum(rows, sums) / found.n

    def products(entries: np.ndarray) -> np.ndarray:
        apart = found.centred(entries) @ projection - mean
        return (apart.T @ apart).ravel()

    covariance = distributed_sum(rows, products) / found.n
    return float(np.abs(covariance.reshape(size, size) - np.eye(size)).max())


def projected(rows: DataFrame, found: Whitening) -> DataFrame:
    """One row per vector and component."""
    size = len(found.eigenvalues)
    explained = found.eigenvalues / found.trace if size else np.zeros(0)
    projection = found.projection

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows or not size:
                continue
            entries = _matrix(batch.column("entries"))
            n = len(entries)
            of = pa.array(np.repeat(np.arange(n), size))
            whitened = found.centred(entries) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(of),
                    pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), n)),
                    pa.array(np.full(n * size, found.n, np.int64)),
                    pa.array(found.deviations(entries), pa.int64()).take(of),
                    pa.array(whitened.ravel()),
                    pa.array(np.tile(explained, n)),
                    pa.array(np.full(n * size, found.identity_error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.select("vec_id", "entries").mapInArrow(
        project,
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double,"
        " explained double, identity_error double",
    )


def whitened(
    vectors: DataFrame,
    rule: WhiteningRule = WhiteningRule(),
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """One row per vector and component: ``n``, ``deviation``, ``whitened``, ``explained``.

    ``identity_error`` tells how far the covariance of ``whitened`` is from the identity.
    """
    narrow = vectors.select(
        column(vec_id).cast("bigint").alias("vec_id"), column(embedding).alias("vector")
    )
    # Merging partitions needs no shuffle, and does nothing where there are fewer.
    parallel = narrow.sparkSession.sparkContext.defaultParallelism
    files = max(parallel, min(MOST_FILES, input_bytes([narrow]) // FILE_BYTES))
    rows = saved(whole_entries(narrow, rule).coalesce(files), "whitening-rows")
    parts = []
    # One row per length of vectors: one, in a sound table.
    for length, n in sorted(tuple(r) for r in rows.groupBy("length").count().collect()):
        own = rows.where(F.col("length") == length)
        parts.append(projected(own, fit(own, n, rule)))
    if not parts:
        none = Whitening(0, np.zeros(0), np.zeros(0), np.zeros((0, 0)), np.zeros(0), 0.0)
        parts = [projected(rows, none)]
    return reduce(DataFrame.union, parts).withColumnRenamed("vec_id", vec_id)
