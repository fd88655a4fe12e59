import pytest

ROWS = [
    (1, "A card 4539 1488 0343 6467 and a.b@c.example.com, call +1 (202) 555-0143.", "en", "s1", 10),
    (2, "a card 4539 1488 0343 6467 and  a.b@c.example.com, call +1 (202) 555-0143.", "en", "s1", 10),
    (3, None, None, None, None),
    (4, "", "en", "s2", 0),
    (5, " \t\n", None, "s2", 3),
    (6, "one two three four five six seven eight nine ten eleven twelve", "en", "s3", 5),
    (7, "one two three four five six seven eight nine ten eleven twelve", "en", "s3", 5),
    (7, "one two three four five six seven eight nine ten eleven twelve", "en", "s3", 5),
    (None, "one two three four five six seven eight nine ten eleven twelve", "en", None, 5),
    (8, "onetwo three four five six seven eight nine ten eleven twelve", "fr", "s3", 5),
    (9, "x1.2.3.4.5.6.7.8 999.1.2.3.4 1.2.3.4@d.e.f_g@h.i @@ a@b +12345678 9", "de", "s4", 5),
    (10, "word " * 30000, "en", "s4", 150000),
    (11, "7" * 30000 + " " + "a" * 30000 + "@" + "b-" * 5000, "en", "s4", 1),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def sf(spark, docs, tmp_path_factory):
    """A folder of tables with the rows above."""
    at = tmp_path_factory.mktemp("sf")
    docs.write.parquet(f"{at}/documents.parquet")
    return str(at)


@pytest.fixture(scope="session")
def sf_empty(spark, docs, tmp_path_factory):
    at = tmp_path_factory.mktemp("none")
    docs.limit(0).write.parquet(f"{at}/documents.parquet")
    return str(at)


@pytest.fixture(scope="session")
def clashing(docs):
    """The rows with further columns whose names the operators might use themselves."""
    out = docs
    for c in ("id", "key", "row", "size", "h", "salt", "kept", "spans", "t", "maybe", "n"):
        out = out.withColumn(c, out.doc_id)
    return out
