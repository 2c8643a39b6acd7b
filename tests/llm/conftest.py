import pytest

SF = SF_SMALL = "/root/testdata/sf0.001"  # the second name for tests beside this folder that take this file for theirs


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


#: Nulls, empty and odd texts, repeated rows, and columns whose names clash with those of results.
ODD_TEXTS = [None, "", " ", "\n\n", "one", "two words", "a b c d", "The cat sat. The cat sat.", "é ü ß 😀 你好 世界", "x" * 5000,
             "tab\tand  double  space \n line", "<|endoftext|> special <|startoftext|>", "it's don't 'll", "!!! ### $$$", "12 345 6.7",
             " nbsp  em space", "same text again", "same text again", "trailing space ", " leading", "a\x00b \x1c c"]


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(i if i != 3 else None, t, None if i % 5 == 0 else "en", None if i % 7 == 0 else f"s{i % 2}", -1, "x", 0) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[7], rows[7]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, shard string, n_tokens int").repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("false")
