import random

from tessera.llm.decontamination import contaminated, drop_contaminated

ITEMS = [
    (1, "A farmer in the valley sold 12 apples to Maria and then Maria gave 12 apples back to the old farmer for free"),
    (2, "the quick brown fox jumps over the lazy dog while seven small birds watch from the tall green tree nearby"),
    (3, "short item"), (4, None), (5, ""), (6, "12 13 14 15 16 17 18 19 20"), (2, "the quick brown fox jumps over the lazy dog while seven small birds watch from the tall green tree nearby"),
]


def bench(spark):
    return spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")


def test_cases(spark, docs_of):
    rng = random.Random(1)
    filler = lambda n: " ".join(f"q{rng.randrange(10**6)}x" for _ in range(n))
    two = ITEMS[1][1]
    rows = [
        (1, filler(30) + "\n" + ITEMS[0][1] + " " + filler(20)),  # verbatim
        (2, filler(9) + " " + ITEMS[0][1].replace("12", "35").replace("Maria", "Elena") + " " + filler(9)),  # other numbers and names
        (3, ITEMS[0][1].replace("sold 12", "sold 31").replace("gave 12", "gave 99").replace("to Maria", "to Elena").replace("then Maria", "then Paula")),  # inconsistent
        (4, filler(400)), (5, None), (6, ""), (7, " \n"), (8, "short item"), (9, "a short item of another kind"),
        (10, two.upper() + "! " + two), (11, " ".join(two.split()[:9])), (12, "21 22 23 24 25 26 27 28 29"),
        (None, two), (13, two), (13, two), (14, filler(40_000) + " " + two), (15, " ".join(two.split()[:15]) + " " + filler(5))]
    docs = docs_of(rows, "doc_id long, text string, item_id string, t string, w string, text_md5 string")
    got = sorted({(r.doc_id, r.item_id) for r in contaminated(spark, docs, bench(spark)).collect()}, key=str)
    assert got == sorted([(1, 1), (2, 1), (10, 2), (None, 2), (13, 2), (14, 2), (15, 2)], key=str)
    assert contaminated(spark, docs, bench(spark)).filter("doc_id = 13").count() == 2
    kept = drop_contaminated(spark, docs, bench(spark))
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7, 8, 9, 11, 12]


def test_planted_passages(spark):
    """On the given tables, exactly the documents that hold an item word by word are found."""
    d = "/root/testdata/sf0.01"
    docs, items = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/benchmark.parquet")
    norm = lambda t: f" {' '.join((t or '').lower().split())} "
    texts = [(r.doc_id, norm(r.text)) for r in docs.collect()]
    want = {(i, b.item_id) for b in items.collect() for i, t in texts if norm(b.text).strip() in t}
    got = {(r.doc_id, r.item_id) for r in contaminated(spark, docs, items).collect()}
    assert want and want <= got
    assert len(got - want) <= len(want) // 10, got - want


def test_empty(spark, docs_of):
    none = docs_of([], "doc_id long, text string")
    some = docs_of([(1, "a b c d e f g h i")], "doc_id long, text string")
    empty = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(spark, none, bench(spark)).count() == 0 and contaminated(spark, some, empty).count() == 0
    assert drop_contaminated(spark, some, empty).count() == 1


def test_each_occurrence_has_its_own_values(spark, docs_of):
    """Several copies of an item with other values, also beside the item itself or with a word more."""
    said = "Tom had {} coins and Ann gave {} to {} before {} took {} of the {} that {} kept with {} others in town"
    item = said.format(12, 15, "Maria", "Maria", 12, 15, "Maria", 12)
    one, two = (said.format(a, b, n, n, a, b, n, a) for a, b, n in ((20, 30, "Zoe"), (7, 9, "Elena")))
    mixed = said.format(20, 30, "Zoe", "Elena", 7, 9, "Paula", 31)
    split = [x.replace(" before", " just before") for x in (one, two)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = docs_of([(1, one + " and then " + two), (2, two + " or " + item), (3, one), (4, mixed), (5, " so ".join([one, two, item])),
                    (6, " and ".join(split))], "doc_id long, text string")
    got = {r.doc_id for r in contaminated(spark, docs, items).collect()}
    assert got == {1, 2, 3, 5, 6}


def test_short_and_slot_dense_items_verbatim(spark, docs_of):
    """Items without a countable window, and names in lower case, are found word by word."""
    items = [(1, "What is 12 + 15?"), (2, "Add 3 4 5 6 7 8 9 10 11 12 13"), (3, "did Anna Bell Carl Dora Emil Fritz Gerd Hans Ida see Otto Paul Rosa"),
             (4, "What is 12 + 16?"), (5, "no no no no no yes"), (6, None)]
    docs = docs_of([(1, "so: what is 12 + 15? tell me"), (2, "first add 3 4 5 6 7 8 9 10 11 12 13 now"), (3, "well " + items[2][1].lower() + " today"),
                    (4, "what is 12 + 17 then"), (5, "no no no no no no no yes"), (6, "What is 12 + 16"), (7, "what is 12"), (8, None)],
                   "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert sorted((r.doc_id, r.item_id) for r in contaminated(spark, docs, bench).collect()) == [(1, 1), (2, 2), (3, 3), (5, 5), (6, 4)]
