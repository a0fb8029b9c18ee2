import pyarrow as pa

from tests.conftest import token_documents
from vellumark.functions import porter2
from vellumark.functions.porter2 import stem, stem_lists
from vellumark.operators.tokens import stemmed_documents

# Sample pairs of the published algorithm.
PAIRS = {
    "consign": "consign", "consigned": "consign", "consistency": "consist", "consolatory": "consolatori",
    "consolingly": "consol", "conspiracy": "conspiraci", "conspirators": "conspir", "constables": "constabl",
    "knackeries": "knackeri", "knavish": "knavish", "kneeling": "kneel", "knightly": "knight", "knitted": "knit",
    "knives": "knive", "knocking": "knock", "running": "run", "movies": "movi", "international": "intern",
    "generate": "generat", "communism": "communism", "arsenal": "arsenal", "hopping": "hop", "hoping": "hope",
    "relational": "relat", "dying": "die", "ties": "tie", "cries": "cri", "gas": "gas", "kiwis": "kiwi",
    "agreed": "agre", "feed": "feed", "succeeded": "succeed", "say": "say", "enjoyed": "enjoy", "youth": "youth",
    "controlling": "control", "electricity": "electr", "formative": "format", "triplicate": "triplic",
    "adoption": "adopt", "apologies": "apolog", "boyish": "boyish", "happiness": "happi", "skies": "sky",
    "early": "earli", "news": "news", "inning": "inning", "24h": "24h", "ab": "ab", "y": "y", "bias": "bias",
}


def test_published_pairs():
    assert {word: stem(word) for word in PAIRS} == PAIRS


def test_lists_keep_their_shape():
    lists = pa.array([["running", "cats"], [], None, ["running"]], pa.list_(pa.string()))
    assert stem_lists(lists).to_pylist() == [["run", "cat"], [], [], ["run"]]
    assert stem_lists(lists.slice(1)).to_pylist() == [[], [], ["run"]]
    short = pa.array([["gas", "ies", "y"], ["y"], ["running"]], pa.list_(pa.string()))
    assert stem_lists(short, 3).to_pylist() == [["gas"], [], ["run"]]
    assert stem_lists(short.slice(0, 0), 3).to_pylist() == []


def test_documents(spark):
    documents = token_documents(
        spark, {"1": ("M", ["running", "adventures", "running"]), "2": ("M", ["aes"]), "3": ("M", ["gas", "ies"])}
    )
    rows = {r["content_id"]: r["tokens"] for r in stemmed_documents(documents).collect()}
    short = [t for t in (stem("gas"), stem("ies")) if len(t) >= 3]
    expected = {"1": ["run", "adventur", "run"], "3": short}
    if len(stem("aes")) >= 3:
        expected["2"] = [stem("aes")]
    assert rows == expected


def test_parts_of_a_batch_are_stemmed_apart(monkeypatch):
    lists = [["running", "is"], None, [], ["cats"] * 5, ["ponies", "of"], ["skies"]]
    whole = porter2.stem_lists(pa.array(lists, pa.list_(pa.string())), 3).to_pylist()
    assert whole == [["run"], [], [], ["cat"] * 5, ["poni"], ["sky"]]
    seen = []
    plain = porter2._stemmed
    monkeypatch.setattr(porter2, "TOKENS_AT_ONCE", 3)
    monkeypatch.setattr(porter2, "_stemmed", lambda part, least: seen.append(len(part)) or plain(part, least))
    assert porter2.stem_lists(pa.array(lists, pa.list_(pa.string())), 3).to_pylist() == whole
    assert len(seen) > 2 and sum(seen) == len(lists)
    assert porter2.stem_lists(pa.array([], pa.list_(pa.string()))).to_pylist() == []
    assert porter2.stem.cache_info().maxsize <= 50_000
