"""Pairs of sets that overlap enough, among sets that share a key: whole cells of them are compared at once.

Where a key is shared by many sets, the pairs below it are far more than the sets. So the rows of a key are dealt to a grid of
cells with up to ``CELL`` sets a side, a cell is compared by matrix products in one task, and a pair is given by the first key it
shares only: nothing has to be told apart or joined afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, functions as F, types as T

CELL = 4_096


def compare_cells(threshold: float, tile: int = 512, small: int = 512, dense: int = 300, rows_out: int = 65_536) -> Callable[[Iterator], Iterator]:
    """Reads Arrow batches ``(cell, right, values, words, before)`` in order of their cells, and gives ``(left_value, right_value, score)``.

    A pair counts if both rows have the same cell, their ``words`` overlap by the threshold and their ``before`` not at all.
    Cells of few rows are compared together. All is nested here, so that it travels to workers that do not know this package.
    """
    share = threshold / (1 + threshold)

    def shared(lists, right, place, n_left, n_right):
        """A function that counts the common entries of the left rows from one place to another with all right rows.

        Entries in many rows of both sides are columns of a matrix product, the others are paired off one by one.
        """
        import numpy as np
        import pyarrow.compute as pc

        row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
        code = lists.flatten().dictionary_encode().indices.to_numpy()
        on_left, on_right = np.flatnonzero(~right[row]), np.flatnonzero(right[row])
        on_right = on_right[np.argsort(code[on_right], kind="stable")]
        (x, u), (y, v) = ((place[row[k]], code[k]) for k in (on_left, on_right))
        known = int(code.max()) + 1 if len(code) else 0
        counts = np.bincount(v, minlength=known)
        pairs = np.bincount(u, minlength=known) * counts
        often, starts = pairs > n_left * n_right / dense, np.cumsum(counts) - counts
        column = np.cumsum(often) - 1
        a, b = (np.zeros((n, int(often.sum())), np.float32) for n in (n_left, n_right))
        for matrix, rows, codes in ((a, x, u), (b, y, v)):
            many = often[codes]
            matrix[rows[many], column[codes[many]]] = 1
        few = np.flatnonzero(~often[u] & (counts[u] > 0))
        x, u = x[few], u[few]

        def count(start, end):
            found = a[start:end] @ b.T
            from_, to = np.searchsorted(x, (start, end))
            times = counts[u[from_:to]]
            total = int(times.sum())
            if total:
                at = np.arange(total) - np.repeat(np.cumsum(times) - times, times) + np.repeat(starts[u[from_:to]], times)
                flat = np.repeat(x[from_:to] - start, times) * n_right + y[at]
                found += np.bincount(flat, minlength=found.size).reshape(found.shape)
            return found

        return count

    def given(values, left, right, score):
        """Every value of the left set with every value of the right one."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        size, flat = pc.list_value_length(values).to_numpy().astype(np.int64), values.flatten()
        first, times = np.cumsum(size) - size, size[left] * size[right]
        ends = np.cumsum(times)
        for start in range(0, int(ends[-1]), rows_out):
            k = np.arange(start, min(start + rows_out, int(ends[-1])))
            p = np.searchsorted(ends, k, "right")
            i, j = np.divmod(k - ends[p] + times[p], size[right[p]])
            yield pa.RecordBatch.from_arrays(
                [flat.take(pa.array(first[left[p]] + i)), flat.take(pa.array(first[right[p]] + j)), pa.array(score[p])],
                names=["left_value", "right_value", "score"])

    def block(table, cell):
        import numpy as np
        import pyarrow.compute as pc

        right = table["right"].to_numpy()
        sides = np.flatnonzero(~right), np.flatnonzero(right)
        n_left, n_right = map(len, sides)
        if not n_left or not n_right:
            return
        place = np.empty(len(right), np.int64)
        for side in sides:
            place[side] = np.arange(len(side))
        values, words, before = (table[name].combine_chunks() for name in ("values", "words", "before"))
        size = pc.list_value_length(words).to_numpy().astype(np.int64)
        least = (share * size).astype(np.float32)
        common, earlier = (shared(lists, right, place, n_left, n_right) for lists in (words, before))
        several = cell[0] != cell[-1]
        for start in range(0, n_left, tile):
            lefts = sides[0][start:start + tile]
            overlap = common(start, start + len(lefts))
            # Rounded, so a little too many here; told exactly below.
            i, j = np.nonzero(overlap >= np.add.outer(least[lefts] - np.float32(0.01), least[sides[1]]))
            left, other, n = lefts[i], sides[1][j], np.rint(overlap[i, j]).astype(np.int64)
            total = size[left] + size[other]
            keep = n >= share * total - 1e-9
            if several:
                keep &= cell[left] == cell[other]
            if keep.any():
                keep &= earlier(start, start + len(lefts))[i, j] < 0.5
            if keep.any():
                yield from given(values, left[keep], other[keep], n[keep] / (total[keep] - n[keep]))

    def compare(batches):
        import numpy as np
        import pyarrow as pa

        def blocks(table, cell, starts):
            at = 0
            for end in [*starts.tolist(), len(cell)]:
                if end - at >= small or end == len(cell):
                    yield from block(table.slice(at, end - at), cell[at:end])
                    at = end

        def cells(table):
            cell = table["cell"].combine_chunks().dictionary_encode().indices.to_numpy()
            return cell, np.flatnonzero(np.diff(cell)) + 1

        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = (table if rest is None else pa.concat_tables([rest, table])).combine_chunks()
            cell, starts = cells(table)
            last = int(starts[-1]) if len(starts) else 0
            if last:
                yield from blocks(table.slice(0, last), cell[:last], starts[:-1])
            rest = table.slice(last)
        if rest is not None and len(rest):
            yield from blocks(rest, *cells(rest))

    return compare


def deal(rows: DataFrame, cell: int) -> DataFrame:
    """``(cell, right, values, words, before)``: the rows of a key that more than ``cell`` rows of a side share go to a grid.

    A side is cut into parts of about ``cell`` rows, and each goes to as many cells as the other side has parts. Sent to the
    tasks are the counts of such keys, fewer than one for ``cell`` rows.
    """
    sides = [F.count_if(~F.col("right")), F.count_if("right")]
    crowds = (rows.groupBy("key").agg(*[n.alias(name) for n, name in zip(sides, ("n_left", "n_right"))])
              .filter(F.greatest("n_left", "n_right") > cell))
    held = rows.join(F.broadcast(crowds), "key", "left")
    left, right = (F.coalesce(F.ceil(F.col(n) / cell), F.lit(1)) for n in ("n_left", "n_right"))
    # Without rows on the other side there is one part of it, so that the sequence does not run backwards.
    own = F.pmod(F.xxhash64("values"), F.greatest(F.when(F.col("right"), right).otherwise(left), F.lit(1)))
    others = F.sequence(F.lit(0).cast("long"), F.greatest(F.when(F.col("right"), left).otherwise(right), F.lit(1)) - 1)
    dealt = held.select("key", "right", "values", "words", "before", own.alias("own"), F.explode(others).alias("other"))
    grid = F.when(F.col("right"), F.concat_ws(" ", "other", "own")).otherwise(F.concat_ws(" ", "own", "other"))
    return dealt.select(F.concat_ws(" ", grid, F.col("key").cast("string")).alias("cell"), "right", "values", "words", "before")


def overlapping(rows: DataFrame, threshold: float, cell: int | None = None) -> DataFrame:
    """``(left_value, right_value, score)`` of rows ``(key, right, values, words, before)`` of one key whose words overlap enough.

    ``before`` are the keys of the row that come before this one, in an order that is the same for all rows: a pair that shares
    one of them was given there.
    """
    spark, cells = rows.sparkSession, deal(rows, cell or CELL)
    # Pairs grow faster than rows, so there are many tasks for few bytes.
    parts = max(16 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    value = rows.schema["values"].dataType.elementType
    kind = T.StructType([T.StructField("left_value", value), T.StructField("right_value", value), T.StructField("score", T.DoubleType())])
    return cells.repartition(parts, "cell").sortWithinPartitions("cell").mapInArrow(compare_cells(threshold), kind)
