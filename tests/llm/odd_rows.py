import pytest

SMALL = "/root/testdata/sf0.001"
#: Column names that operators use themselves.
CLASHES = ["score", "lang_pred", "key", "gone", "left", "cut", "judged", "leaks", "size_of", "portion", "band", "root", "id_text", "line", "doc"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
BLUE = "the quick brown fox jumps over the lazy dog while seven grey geese fly across a wide cold lake near an old stone mill"
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(60_000))

ODD = [
    (1, BLUE, "en", "a", None),
    (2, BLUE, "en", "a", 5),  # equal text
    (2, BLUE, "en", "a", 5),  # repeated row
    (3, BLUE + " tonight", "en", None, 5),  # near text
    (None, "una casa grande y una mesa pequeña en el jardín de la abuela", "es", "b", 3),
    (None, "una casa grande y una mesa pequeña en el jardín de la abuela", "es", "b", 3),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n ", None, "b", 3),
    (7, "123 456 !!! ---", "en", "c", 9),
    (8, "Das ist ein Haus", "de", "c", 9),
    (9, LONG, "en", "c", len(LONG)),
    (10, None, "en", "a", None),
    (11, "Das ist ein Haus\nund noch eine Zeile mit Wörtern\n\nDAS IST EIN HAUS!", "de", "c", 9),
]


@pytest.fixture(scope="module")
def odd(spark):
    frame = spark.createDataFrame(ODD, SCHEMA).coalesce(3)
    for name in CLASHES:
        frame = frame.selectExpr("*", f"'x' as `{name}`")
    return frame.cache()


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("doc_id = -1")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet").cache()
