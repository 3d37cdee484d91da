"""Pages bound to a publication and a query."""

from datetime import datetime, timedelta

import pytest

from brontide.operators import core
from brontide.plans import published

AT = datetime(2026, 8, 12)


def test_pages_joined_are_the_whole_result(spark):
    rows = spark.createDataFrame([(i // 3, AT + timedelta(hours=i % 5), i) for i in range(40)], "k int, at timestamp_ntz, i int")
    order, query = ["k", "at", "i"], core.fingerprint("q", {"place": "p"})
    found, cursor = [], None
    while True:
        page, cursor = core.bound_page(rows, order, 7, "pub-1", query, cursor)
        found += [r.i for r in page]
        if cursor is None:
            break
    assert found == [r.i for r in rows.orderBy(*order).collect()]


def test_foreign_cursors_are_refused(spark):
    rows = spark.range(10)
    query = core.fingerprint("q", {"place": "p"})
    _, cursor = core.bound_page(rows, ["id"], 4, "pub-1", query)
    assert [r.id for r in core.bound_page(rows, ["id"], 4, "pub-1", query, cursor)[0]] == [4, 5, 6, 7]
    for publication, asked, own in (("pub-2", query, cursor), ("pub-1", core.fingerprint("q", {"place": "other"}), cursor), ("pub-1", query, "nonsense")):
        with pytest.raises(ValueError):
            core.bound_page(rows, ["id"], 4, publication, asked, own)


def test_covered_pages(spark):
    risk = spark.createDataFrame([("p", AT + timedelta(hours=h), f"p|{h:02d}", "heat") for h in range(9)] + [("q", AT, "q|00", "cold")], "place_id string, forecast_at timestamp_ntz, product_row_id string, risk_labels string")
    availability = spark.createDataFrame([("p", "complete", AT, AT + timedelta(hours=20)), ("q", "incomplete", AT, AT)], "place_id string, availability_status string, available_from_at timestamp_ntz, available_to_at timestamp_ntz")
    t, found, cursor = {"risk": risk, "availability": availability}, [], None
    while True:
        page, cursor = published.covered_page(t, "p", AT, AT + timedelta(hours=12), "pub-1", cursor, 4)
        found += [r.product_row_id for r in page]
        if cursor is None:
            break
        kept = cursor
    assert found == [f"p|{h:02d}" for h in range(9)]
    assert [r.zero_result_reason for r in published.covered_page(t, "q", AT, AT, "pub-1")[0]] == ["range_not_covered"]
    with pytest.raises(ValueError):
        published.covered_page(t, "p", AT, AT + timedelta(hours=13), "pub-1", kept, 4)
