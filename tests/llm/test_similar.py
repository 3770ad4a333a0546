import corpus_pipeline
from cases import awkward, empty

from tessera.llm.simhash import near_duplicates, without_near_duplicates


def similar_documents(df):
    return near_duplicates(df, words=5, similarity=0.8)


def plain_set(text):
    words = (text or "").encode().lower().split()
    k = min(5, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()


def components(sets):
    """Smallest id of each component, over all pairs."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            if 5 * len(x & y) >= 4 * len(x | y):  # both empty, too
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in sets}


def edited(words, places):
    return " ".join(f"x{i}" if i in places else w for i, w in enumerate(words))


def test_pairs_at_and_below_the_threshold(spark):
    base = [f"w{i}" for i in range(104)]  # 100 shingles
    rows = [
        (100, " ".join(base)),
        (101, edited(base, {50, 20})),  # 90 of 110: 0.818
        (102, edited(base, {80, 60, 40})),  # 85 of 115: 0.739 to 100, less to 101
        (103, " ".join(base[:84])),  # 80 of 100, the threshold itself
        (104, " ".join(base[:83])),  # 79 of 100, and 79 of 80 of 103
        (200, "one two three"),
        (201, "One  two\nthree"),
        (202, "one two four"),
    ]
    df = awkward(spark, rows)
    got = similar_documents(df).collect()
    sets = {r.doc_id: plain_set(r.text) for r in df.collect() if r.doc_id is not None}
    assert len(got) == df.count()
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == components(sets)
    by = {r.doc_id: r.component_id for r in got}
    assert [by[i] for i in (101, 102, 103, 104, 201, 202)] == [100, 102, 100, 100, 200, 202]


def test_stage_drops_edited_copies(spark):
    """Copies with a few words changed differ in more than three bits of a fingerprint."""
    base = [f"w{i}" for i in range(300)]
    docs = spark.createDataFrame([(i, edited(base, {40 * i + 7, 40 * i + 20} if i else ())) for i in range(7)], "doc_id long, text string")
    assert [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()] == [0]


def test_whole_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: plain_set(r.text) for r in df.collect()}
    assert {r.doc_id: r.component_id for r in similar_documents(df).collect()} == components(sets)


def test_empty(spark):
    assert similar_documents(empty(spark)).collect() == []


def test_large_groups_of_near_copies(spark):
    """Hundreds of texts that differ in a word each: groups of close fingerprints, and those beyond them."""
    base = [f"w{i}" for i in range(400)]
    rows = [(i, edited(base, {i})) for i in range(150)] + [(1000 + i, edited(base, {i, i + 100, i + 200})) for i in range(40)]
    df = spark.createDataFrame([*rows, (5000, "something else altogether in here")], "doc_id long, text string")
    sets = {r.doc_id: plain_set(r.text) for r in df.collect()}
    assert {r.doc_id: r.component_id for r in similar_documents(df).collect()} == components(sets)


def test_rows_that_stay(spark):
    df = awkward(spark, [(3, "an id that another row has as well"), (9, "no id at all"), (None, "this one is alone here")])
    left = [(r.doc_id, r.text) for r in without_near_duplicates(df).collect()]
    assert without_near_duplicates(df).columns == df.columns
    assert (3, "an id that another row has as well") in left and (None, "this one is alone here") in left
    assert (9, "no id at all") in left and (None, "no id at all") not in left  # ids come before none
    assert left.count((7, "one")) == 2 and (1, "Some plain words in a row here.") in left and 2 not in {i for i, _ in left}
    assert [i for i, t in left if not (t or "").split()] == [3]  # of null, empty and blank texts
    assert without_near_duplicates(empty(spark)).collect() == []
