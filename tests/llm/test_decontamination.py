"""Operator 10: planted passages, other numbers and names, near misses, odd rows."""
import pytest
from pyspark.sql import functions as F

from acct_health.llm import decontamination as d

ITEM = "On Monday the farmer Natalia sold 48 clips to friends and then Natalia sold 24 km of rope to Peter again quickly"
FILLER = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor"


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(1, ITEM), (2, ITEM), (3, None), (4, ""), (5, "short item of five words"), (None, "an item without any number of its own here")],
                                 "item_id long, text string")


def found(spark, items, texts, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in d.contaminated(docs, items, **more).collect() if r["item_id"] != 5}


def test_cases(spark, items):
    swapped = ITEM.replace("Natalia", "Olga").replace("48", "96").replace("24", "7").replace("Peter", "Ivan")
    mixed = swapped.replace("then Olga", "then Boris")  # one name of the item stands for two
    got = found(spark, items, [f"{FILLER}. {ITEM} {FILLER}", f"{FILLER} {ITEM.upper()}", f"{FILLER}. {swapped}", f"{FILLER}. {mixed}", FILLER,
                               None, "", f"{FILLER} the farmer sold clips to friends {FILLER}", ITEM.replace(" ", "\n \t"), ITEM])
    assert set(got) >= {0, 2, 8, 9} and set(got) <= {0, 1, 2, 8, 9}
    assert got[0]["same_slots"] and not got[2]["same_slots"] and got[0]["item_id"] == 1
    assert got[0]["first_word"] == len(FILLER.split())


def test_long_text_in_runs(spark, items, monkeypatch):
    words = (FILLER.split() * 40)[:300]
    for at in (0, 20, 55, 59, 60, 61, 64, 100, 250):
        text = " ".join(words[:at] + ITEM.split() + words[at:])
        plain = [(done + i, h) for done, t in d.runs(text, 8) for i, h in enumerate(t.windows(8).tolist())]
        monkeypatch.setattr(d, "RUN", 64)
        cut = {(done + i, h) for done, t in d.runs(text, 8) for i, h in enumerate(t.windows(8).tolist())}
        monkeypatch.undo()
        assert set(plain) <= cut


@pytest.mark.parametrize("run", [16, 64, None])
def test_words_without_tokens_within_a_passage(monkeypatch, run):
    """However long the stretch of punctuation, all windows of the item are found."""
    want = {(i, h) for _, t in d.runs(ITEM, 8) for hashes in t.keys(8) for i, h in enumerate(hashes.tolist()) if h}
    if run:
        monkeypatch.setattr(d, "RUN", run)
    for stretch in (3, 15, 40, 150) if run else (30_000, 70_000, 140_000):
        for at in (1, 5, 9):
            words = ITEM.split()
            text = " ".join([*words[:at], *["***"] * stretch, *words[at:]])
            got = {(done + i, h) for done, t in d.runs(text, 8) for hashes in t.keys(8) for i, h in enumerate(hashes.tolist())}
            assert want <= got


def test_against_plain_search(spark):
    """Each document that holds eight running words of an item is found, and no other."""
    sf = "/root/testdata/sf0.001"
    items, docs = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("benchmark", "documents"))
    words = lambda t: [w for w in (x.strip(".,!?$%&*#|").lower() for x in t.split()) if w]
    windows = {}
    for r in items.collect():
        w = words(r["text"])
        for i in range(len(w) - 7):
            windows.setdefault(tuple(w[i:i + 8]), set()).add(r["item_id"])
    want = set()
    for r in docs.collect():
        w = words(r["text"])
        want |= {(r["doc_id"], k) for i in range(len(w) - 7) for k in windows.get(tuple(w[i:i + 8]), ())}
    got = {(r["doc_id"], r["item_id"]) for r in d.contaminated(docs, items).collect()}
    assert got == want and want
    bad = {a for a, _ in want}
    assert {r["doc_id"] for r in d.drop_contaminated(docs, items).collect()} == {r["doc_id"] for r in docs.collect()} - bad


def test_odd(spark, odd, empty, items):
    assert d.contaminated(odd, items).count() == 0
    assert d.contaminated(empty, items).count() == 0
    assert d.contaminated(odd, items.where("false")).count() == 0
    kept = d.drop_contaminated(odd, items)
    assert kept.columns == odd.columns and kept.count() == odd.count()
    planted = odd.withColumn("text", F.when(F.col("doc_id") == 7, F.lit(ITEM)).otherwise(F.col("text")))
    assert d.contaminated(planted, items).count() == 3  # the row and its two repeats
    assert d.drop_contaminated(planted, items).count() == odd.count() - 3


DENSE = ["Compute 12 plus 30 minus 7 times 4 plus 2 minus 9 times 3.",
         "Alice paid 12 coins, Bob paid 30 coins, Peter paid 7 coins, Mary paid 9.", "12 30 7 4 2 9 3 8 5"]


def test_items_dense_in_placeholders(spark):
    """Copied word for word they are found; with other numbers they are no more than a common pattern."""
    items = spark.createDataFrame(list(enumerate(DENSE)), "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{FILLER}. {t} {FILLER}") for i, t in enumerate(DENSE)] + [(9, f"{FILLER}. {DENSE[2][::-1]} {FILLER}")],
                                 "doc_id long, text string")
    got = d.contaminated(docs, items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(0, 0), (1, 1), (2, 2)}
    assert all(r["same_slots"] and r["first_word"] == len(FILLER.split()) for r in got)


def test_case_and_place_hide_nothing(spark):
    """Word for word, in any case, in mid-sentence, and short."""
    short = ["What is the capital of France?", "Weng earns 12 dollars"]
    items = spark.createDataFrame(list(enumerate([ITEM, *short])), "item_id long, text string")
    copies = [(10 * i + k, f"{before} {t} {FILLER}") for i, text in enumerate([ITEM, *short]) for k, (before, t) in enumerate(
        (before, t) for before in (FILLER, FILLER + ".") for t in (text, text.lower(), text.upper(), text.title()))]
    got = d.contaminated(spark.createDataFrame(copies, "doc_id long, text string"), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == {(k, k // 10) for k, _ in copies}
    assert {r["doc_id"]: r["n_windows"] for r in got if r["item_id"] == 0} == {k: len(ITEM.split()) - 7 for k, _ in copies[:8]}
    titled = spark.createDataFrame([(5, ITEM.title())], "item_id long, text string")
    got = d.contaminated(spark.createDataFrame(copies[:8], "doc_id long, text string"), titled).collect()
    assert {r["doc_id"] for r in got} == set(range(8))


def test_one_edit_hides_no_copy(spark):
    """Windows copied word for word count, though a number or name that came before is changed later on."""
    long = "The baker sold 48 loaves of bread on the first morning and again sold 48 loaves of bread when the market closed at night"
    near = "The old baker counted all the bread in the shop and sold 48 loaves and 48 rolls before noon"
    items = spark.createDataFrame([(1, ITEM), (2, long), (3, near)], "item_id long, text string")
    texts = ["50 loaves".join(long.rsplit("48 loaves", 1)), "Olga".join(ITEM.rsplit("Natalia", 1)), long.replace("48", "31"), long,
             near.replace("48 rolls", "50 rolls"), near.replace("48 loaves and 48", "31 loaves and 50").replace("counted all", "has")]
    docs = spark.createDataFrame(list(enumerate(f"{FILLER}. {t}" for t in texts)), "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in d.contaminated(docs, items).collect()}
    assert set(got) == {(0, 2), (1, 1), (2, 2), (3, 2), (4, 3)}
    assert {got[k, 2]["n_windows"] for k in (0, 2, 3)} == {len(long.split()) - 7}
    assert [got[k, 2]["same_slots"] for k in (0, 2, 3)] == [False, False, True]
    # 48 stands for 48 and 50: the windows up to the change are left
    assert got[4, 3]["n_windows"] == near.split().index("48", 13) - 7 and got[4, 3]["same_slots"]
