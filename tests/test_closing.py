"""Dates that close by themselves, page by page."""

import pandas as pd

from stopgrid.streaming import closing


class Held:
    """The state of one key between steps."""

    def __init__(self):
        self.exists, self.get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def events(*batches):
    state, out = Held(), []
    for batch in batches:
        frame = pd.DataFrame(batch, columns=["total", "start", "n"])
        out.append([tuple(r) for d in closing._step(("d", "r"), iter([frame]), state) for r in d[["event", "landed", "total"]].to_numpy()])
    return out


def test_a_date_closes_once_all_rows_came():
    assert events([(7, 1, 5)], [(7, 6, 2)]) == [[], [("closed", 7, 7)]]
    assert events([(7, 6, 2)], [(7, 1, 5)], [(7, 1, 5)]) == [[], [("closed", 7, 7)], [("late", 7, 7)]]
    # a doubled page does not stand for a missing one, a failed one brings nothing
    assert events([(9, 1, 5), (9, 1, 5)], [(None, 6, 0)], [(9, 6, 4)]) == [[], [], [("closed", 9, 9)]]
    # the total may come late or grow; an announced nothing closes at once
    assert events([(None, 1, 5)], [(5, 1, 5)]) == [[], [("closed", 5, 5)]]
    assert events([(5, 1, 3)], [(8, 4, 2)], [(8, 6, 3)]) == [[], [], [("closed", 8, 8)]]
    assert events([(0, 1, 0)], [(0, 1, 0)]) == [[("closed", 0, 0)], []]


def test_ranges():
    assert closing.merge_ranges([(6, 9), (1, 3), (4, 4), (12, 12), (8, 10)]) == [(1, 4), (6, 10), (12, 12)]
    assert closing.merge_ranges([]) == []


def test_a_stream_goes_on_where_it_stopped(spark, tmp_path):
    pages, out, checkpoint = (str(tmp_path / n) for n in ("pages", "out", "checkpoint"))

    def land(*rows):
        spark.createDataFrame(rows, closing.SPANS).coalesce(1).write.mode("append").parquet(pages)
        closing.follow(spark.readStream.schema(closing.SPANS).parquet(pages), out, checkpoint)
        spark.catalog.refreshByPath(out)
        return sorted((r["date"], r["route_no"], r["event"]) for r in spark.read.schema(closing.EVENTS).parquet(out).collect())

    assert land(("d1", "r", 4, 1, 2), ("d2", "r", 2, 1, 2)) == [("d2", "r", "closed")]
    assert land(("d1", "r", 4, 3, 2)) == [("d1", "r", "closed"), ("d2", "r", "closed")]
    assert land(("d2", "r", 2, 1, 2)) == [("d1", "r", "closed"), ("d2", "r", "closed"), ("d2", "r", "late")]
