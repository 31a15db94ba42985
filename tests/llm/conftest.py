import pytest
from pyspark.sql import Row

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls in every column, empty, long and repeated texts, repeated rows, a tie."""
    from pyspark.sql import functions as F

    base = " ".join(f"word{i}" for i in range(40))
    near = base.replace("word39", "other")
    rows = [
        (1, base, "en", "a", len(base)), (2, base, "en", "a", len(base)), (2, base, "en", "a", len(base)), (3, near, None, None, None),
        (4, "", "en", "a", 0), (5, None, "en", "a", 0), (None, "key is missing here", "en", "a", 3), (None, None, None, None, None),
        (6, "x", "en", "b", 1), (7, "many words " * 60_000, "en", "b", 1), (8, "A\tb c\n\n d▁e \U0001f600", "fr", "b", 1),
        (9, "short\n" + base + "\nend", "en", "b", 1), (10, "\\ <|im_end|> <|", "en", "b", 1), (-3, near, "en", "b", 1),
    ]
    names = [f.split()[0] for f in DOCS.split(", ")]
    return spark.createDataFrame([Row(**dict(zip(names, r))) for r in rows], DOCS).withColumns(
        {"_row": F.lit("mine"), "_doc": F.lit(1), "_hash": F.lit(2), "rep": F.lit("r"), "digest": F.lit(0), "_text": F.lit("t"), "held_out": F.lit("h"), "score": F.lit("s"), "class_id": F.lit("c"), "sequence_id": F.lit("q")}
    )


@pytest.fixture
def no_documents(spark):
    return spark.createDataFrame([], DOCS)
