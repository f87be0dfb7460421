import os
import sys
from datetime import datetime, timedelta

import pandas as pd
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from shopsignals.session import build_session

    s = build_session(
        "shopsignals-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra_conf={"spark.driver.memory": "8g"},
    )
    yield s
    s.stop()


EVENT_DDL = (
    "event_time timestamp, event_type string, product_id int, category_id bigint, "
    "category_code string, brand string, price double, user_id bigint, user_session string"
)


def events_df(spark, rows):
    """rows: dicts with the event columns (missing ones null)."""
    cols = [c.split()[0] for c in EVENT_DDL.split(", ")]
    data = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(data, EVENT_DDL)


@pytest.fixture(scope="session")
def sample_events_pd():
    """Seven shoppers with fixed habits over ten weeks: visits at a personal rhythm,
    a personal favourite shelf, and every third visit with a basket."""
    shelves = ["electronics.audio.speaker", "apparel.coat", "appliances.oven", "furniture.desk", None]
    makers = ["novak", "brill", "tessa", None]
    rows = []
    for shopper in range(7):
        visit, when = 0, datetime(2021, 3, 2, 6 + 2 * shopper, 10)
        while when < datetime(2021, 5, 11):
            for k in range(3 + (visit + shopper) % 4):
                kind = "view"
                if k == 2 and visit % 3 == 0:
                    kind = "cart"
                elif k == 3 and (visit % 3 == 0 or shopper == 5) and shopper != 6:
                    kind = "purchase"
                step = visit * 5 + k * 3 + shopper
                rows.append((
                    when + timedelta(minutes=4 * k), kind, 500 + step % 37, 70 + step % 11,
                    shelves[shopper % 5] if step % 2 else shelves[step % 5], makers[step % 4],
                    round(3.25 + (step * 7919 % 40_000) / 100, 2), 9100 + shopper, f"visit-{shopper}-{visit}",
                ))
            visit += 1
            when += timedelta(hours=19 + 11 * shopper + (visit % 5) * 3)
    rows.sort(key=lambda r: r[0])
    table = pd.DataFrame(rows, columns=[
        "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price", "user_id", "user_session",
    ])
    return table.astype({"product_id": "int32", "category_id": "int64", "user_id": "int64"})


@pytest.fixture(scope="session")
def sample_events(spark, sample_events_pd):
    def plain(v):
        if hasattr(v, "to_pydatetime"):
            return v.to_pydatetime()
        if hasattr(v, "item"):
            return v.item()
        return v

    rows = [{k: plain(v) for k, v in r.items()} for r in sample_events_pd.to_dict("records")]
    return events_df(spark, rows)
