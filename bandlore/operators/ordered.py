"""Order-dependent operators that never sort everything in one task.

A window without a partition, or one over a hot group, runs in a single task. Here the rows are range-partitioned once and
each sorted range is read once as a stream: running sums and following rows are found where the rows are, and written with
the number of their range. Only the first and the last group of a range can go on in another one, so each range reports
those two; what ranges before hold of a group comes back as a small table of offsets. There is no second exchange of rows.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from bandlore.session import scratch_path


def _changes(columns, n):
    """Where the values of the group columns differ from the row before; the first row always counts."""
    out = np.zeros(n, bool)
    out[:1] = True
    for column in columns:
        codes = column.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        out[1:] |= codes[1:] != codes[:-1]
    return out


class Ranged:
    """Rows in total order ``by + order``, cut into ranges.

    ``order`` must end in a unique key if ties may be many, so that a hot value can be cut too. ``ranges`` sets the
    number of ranges; left out, Spark takes its shuffle partitions and merges small ones. It changes no result. The
    range of a row is fixed by writing it: range partitioning samples its input, so a recomputed range could differ.
    """

    def __init__(self, df, by, order, ranges=None):
        self.by, self.order = list(by), list(order)
        keys = [*[F.col(c) for c in self.by], *self.order]
        self.df, self.following = df, []
        parted = df.repartitionByRange(ranges, *keys) if ranges else df.repartitionByRange(*keys)
        self.sorted = parted.sortWithinPartitions(*keys)

    def add_next(self, columns, prefix="next_"):
        """Carry columns of the following row in the group, null for the last row; they come with ``running``."""
        self.following += [(c, f"{prefix}{c}") for c in columns]
        return self

    def positions(self, name="position"):
        """0-based position of every row in its group."""
        ones = Ranged.__new__(Ranged)
        ones.by, ones.order, ones.following = self.by, self.order, self.following
        ones.df, ones.sorted = (d.withColumn("_one", F.lit(1).cast("bigint")) for d in (self.df, self.sorted))
        return ones.running({name: "_one"}).withColumn(name, F.col(name) - 1).drop("_one")

    def running(self, sums):
        """Inclusive running sums. ``sums`` maps a new column to the column it adds up; missing values add nothing."""
        spark, columns, kinds = self.df.sparkSession, self.df.columns, dict(self.df.dtypes)
        kind = {n: "double" if kinds[c] in ("double", "float") else "bigint" for n, c in sums.items()}
        path = scratch_path(spark, "ranges")
        schema = ", ".join(
            [f"`{c}` {kinds[c]}" for c in columns] + [f"`{n}` {kind[n]}" for n in sums]
            + [f"`{n}` {kinds[c]}" for c, n in self.following] + ["_range int", "_edge int"])
        self.sorted.mapInArrow(self._local(sums, kind), schema).write.parquet(path)
        found = spark.read.schema(schema).parquet(path)
        carried = self._offsets(found, sums)
        keys = [*self.by, "_range"]
        names = [f"_o_{n}" for n in sums] + [f"_n_{n}" for _, n in self.following]
        types = [kind[n] for n in sums] + [kinds[c] for c, _ in self.following]
        offsets = spark.createDataFrame(carried, ", ".join(
            [f"`{c}` {kinds[c]}" for c in self.by] + ["_range int"] + [f"`{n}` {k}" for n, k in zip(names, types)]))
        # At most two rows per range.
        same = [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in keys]
        joined = found.where("_edge is null or _edge < 2").alias("l").join(F.broadcast(offsets).alias("r"), same, "left")
        last = F.col("l._edge") == 1
        return joined.select(
            *[F.col(f"l.`{c}`") for c in columns],
            *[(F.col(f"l.`{n}`") + F.coalesce(F.col(f"r._o_{n}"), F.lit(0))).alias(n) for n in sums],
            *[F.when(last, F.col(f"r._n_{n}")).otherwise(F.col(f"l.`{n}`")).alias(n) for _, n in self.following])

    def _local(self, sums, kind):
        """Of a range: its rows with sums, ``_edge`` 1 at its last row; then of its first group a row with ``_edge`` 2 and
        of its last, if another, one with 3, that hold the group's sums and, in the following columns, its first row's."""
        by, following, columns = self.by, self.following, self.df.columns
        names = [*columns, *sums, *(n for _, n in following), "_range", "_edge"]

        def run(batches):
            import pyspark

            part = pyspark.TaskContext.get().partitionId()
            held, total, groups, begun, first = None, None, 0, None, None

            def out(batch, runs, after, edge):
                ready = [pa.array(runs[s], pa.float64() if kind[s] == "double" else pa.int64()) for s in sums]
                return pa.record_batch([*(batch.column(c) for c in columns), *ready, *after,
                                        pa.array(np.full(batch.num_rows, part, np.int32)), edge], names)

            def differs(a, b):
                both = pa.Table.from_batches([a.select(by), b.select(by)]).combine_chunks()
                return bool(by) and bool(_changes([both.column(c).combine_chunks() for c in by], 2)[1])

            def finished(batch, runs, starts, behind):
                """A batch whose following row is known: a batch of one row, or None at the range's end."""
                n, after = batch.num_rows, []
                last = behind is None
                ends = pa.array(np.append(starts[1:], last or differs(batch.slice(n - 1), behind)))
                for c, _ in following:
                    column = batch.column(c)
                    moved = pa.concat_arrays([column.slice(1), pa.nulls(1, column.type) if last else behind.column(c)])
                    after.append(pc.if_else(ends, pa.nulls(n, column.type), moved))
                return out(batch, runs, after, pa.array(np.ones(n, np.int32), mask=np.arange(n) < n - 1 if last else np.ones(n, bool)))

            for batch in batches:
                n = batch.num_rows
                if not n:
                    continue
                starts = _changes([batch.column(c) for c in by], n)
                if held is not None:
                    starts[0] = differs(held[0].slice(held[0].num_rows - 1), batch.slice(0, 1))
                    yield finished(*held, batch.slice(0, 1))
                    if starts[0] and groups == 1:
                        first = begun, total
                segments = np.concatenate(([0], np.flatnonzero(starts[1:]) + 1))
                which, runs = np.repeat(np.arange(len(segments)), np.diff(np.append(segments, n))), {}
                for s, c in sums.items():
                    values = batch.column(c).fill_null(0).to_numpy(zero_copy_only=False)
                    values = values.astype(np.float64 if kind[s] == "double" else np.int64)
                    upto = np.cumsum(values)
                    runs[s] = upto - (upto[segments] - values[segments])[which]
                    if not starts[0]:
                        runs[s][which == 0] += total[s]
                if first is None and groups + starts[0] == 1 and len(segments) > 1:
                    first = batch.slice(0, 1) if starts[0] else begun, {s: runs[s][segments[1] - 1] for s in sums}
                new = np.flatnonzero(starts)
                groups += len(new)
                if len(new):
                    begun = batch.slice(int(new[-1]), 1)
                total = {s: runs[s][-1] for s in sums}
                held = batch, runs, starts
            if held is None:
                return
            yield finished(*held, None)
            edges = [(2, begun, total)] if first is None else [(2, *first), (3, begun, total)]
            for mark, row, totals in edges:
                yield out(row, {s: np.array([totals[s]]) for s in sums}, [row.column(c) for c, _ in following],
                          pa.array([mark], pa.int32()))

        return run

    def _offsets(self, found, sums):
        """Per group at the edge of a range, and range: what the ranges before hold, and the row behind the range."""
        edges = found.where("_edge > 1").orderBy("_range", "_edge").collect()  # two rows per range at most
        key = lambda row: tuple(row[c] for c in self.by)
        behind, later, before, out = {}, {}, {}, []
        for row in reversed(edges):
            behind[row["_range"], key(row)] = later.get(key(row), [None] * len(self.following))
            later[key(row)] = [row[n] for _, n in self.following]
        for row in edges:
            held = before.get(key(row), [type(row[n])(0) for n in sums])
            out.append((*key(row), row["_range"], *held, *behind[row["_range"], key(row)]))
            before[key(row)] = [a + row[n] for a, n in zip(held, sums)]
        return out
