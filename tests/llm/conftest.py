import pytest

from llm_texts import prose


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls, empty and very long texts, repeated rows, and columns named like the operators' own."""
    rows = [
        (1, prose(1, 80)), (2, None), (3, ""), (None, prose(2, 60)), (4, prose(3, 70)), (4, prose(3, 70)),
        (5, prose(4, 20000)), (6, " \n\t\n "), (7, prose(3, 70)), (8, "x" * 50000), (None, None),
        (9, "one\n\none\n" + prose(5, 60)),
    ]
    names = ("ids", "decoded", "base", "n_lines", "keys", "shard", "text_hash", "size", "position", "same", "word", "block")
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for i, name in enumerate(names):
        frame = frame.selectExpr("*", f"{i} AS {name}")
    return frame


@pytest.fixture(scope="session")
def empty(messy):
    return messy.where("1 = 0")
