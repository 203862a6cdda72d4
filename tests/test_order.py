"""Reports come in the order that another engine gives the same rows, ties and nulls included."""

from __future__ import annotations

import pytest
from compare import connect
from pyspark.sql import functions as F

from changeloom.oracles import oracle_sql
from changeloom.plans import administration, personnel, sales
from changeloom.plans.views import View, report
from changeloom.queries import queries

FOLDER = "/root/testdata/sf0.001"
VIEWS = {v.name: v for v in (*administration.VIEWS, *personnel.VIEWS, *sales.VIEWS) if v.order}


@pytest.mark.parametrize("name", [n for n in VIEWS if n in queries()])
def test_reports_are_in_order(spark, name):
    view = VIEWS[name]
    columns = [c.lstrip("+") for c in view.order]
    order = ", ".join(f"{c[1:]} ASC NULLS FIRST" if c.startswith("+") else f"{c} DESC NULLS LAST" for c in view.order)
    expected = connect(FOLDER).execute(f"SELECT {', '.join(columns)} FROM ({oracle_sql()[name]}) ORDER BY {order}").fetchall()
    got = [tuple(r) for r in report(queries()[name](spark, FOLDER), view).select(*columns).collect()]
    assert got == expected and len(set(got)) == len(got)
    assert [tuple(r) for r in report(queries()[name](spark, FOLDER), view, limit=3).select(*columns).collect()] == expected[:3]


def test_nulls_and_ties(spark):
    frame = spark.createDataFrame([(1, None), (2, 5), (3, 5), (4, 7), (None, 7)], "k int, n int")
    view = View("v", (), lambda: frame, ("n", "+k"))
    assert [tuple(r) for r in report(frame, view).collect()] == [(None, 7), (4, 7), (2, 5), (3, 5), (1, None)]
    assert report(frame.where(F.lit(False)), view, 2).count() == 0
