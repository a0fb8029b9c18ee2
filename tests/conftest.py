from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vellumark.session import build_session  # noqa: E402
from vellumark.sources.catalogue import RAW_COLUMNS  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def raw_row(show_id, **values):
    row = {
        "show_id": show_id,
        "type": "Movie",
        "title": f"Title {show_id}",
        "country": "Norway",
        "release_year": "2019",
        "rating": "PG",
        "date_added": "March 4, 2021",
        "duration": "90 min",
        "listed_in": "Dramas",
        "description": "A quiet harbour keeps an old secret.",
    }
    row.update(values)
    return tuple(row[name] for name in RAW_COLUMNS)


RAW_ROWS = [
    raw_row("a1", release_year="2020", description="Brave sisters hope to rescue their friends; a happy, warm adventure."),
    raw_row("a2", country=" France , Peru", type="TV Show", duration="2 Seasons", date_added="  July 15, 2020 "),
    raw_row("a3", country=None),
    raw_row("a4", country=""),
    raw_row("a5", country=" , Chile"),
    raw_row("a6", release_year="2014"),
    raw_row("a7", release_year="soon"),
    raw_row("a8", release_year=None),
    raw_row("b1", date_added="2020-07-15"),
    raw_row("b2", date_added=None, duration=None),
    raw_row("b3", duration="no length", title=None, listed_in=""),
    raw_row("b4", duration="99999999999 min", release_year="2015"),
    raw_row("b5", title="Été à Paris", description="Crème brûlée, naïve café 24 12 007 x9 the and"),
    raw_row("b6", title="", listed_in=None, description="?!"),
    raw_row("b7", title="Murder", listed_in="War", description="Killing, murders and dark revenge: a violent death.", type=None),
    raw_row("b8", title="of", listed_in="to", description="in 12345 the with"),
]


@pytest.fixture(scope="session")
def raw(spark):
    schema = ", ".join(f"{name} string" for name in RAW_COLUMNS)
    return spark.createDataFrame(RAW_ROWS, schema)


def token_documents(spark, documents):
    """Documents from {id: (type, tokens)}."""
    rows = [(i, kind, "Peru", f"title {i}", tokens) for i, (kind, tokens) in documents.items()]
    return spark.createDataFrame(
        rows, "content_id string, content_type string, country string, title string, tokens array<string>"
    )
