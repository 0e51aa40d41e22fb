"""Sign dedup, periodic runs and lexical search: edges, and the long way round on small inputs."""

import sys
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent))

import plainly  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from tallyframe.llm import lexical, periodic, sign_dedup  # noqa: E402
from tallyframe.llm.queries import repeat_tails  # noqa: E402

# Sign dedup

VECTORS = "vec_id long, embedding array<double>, label int, class string, n_links string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label, "x", "y") for i, v, label in rows], VECTORS)


def links(df):
    return {row["vec_id"]: (row["n_links"], row["component_id"], row["kept"]) for row in df.collect()}


def near_rows(seed, groups, noise, width=24):
    """Groups of near copies of one direction, of several lengths, and vectors by themselves."""
    random = np.random.default_rng(seed)
    rows = []
    for size in groups:
        middle = random.normal(size=width)
        for _ in range(size):
            rows.append((middle + random.normal(size=width) * noise * random.random()) * random.choice([0.01, 1.0, 300.0]))
    rows += list(random.normal(size=(60, width)))
    order = random.permutation(len(rows))
    return [(int(i), rows[at].tolist(), int(random.integers(0, 3)) if at % 4 == 0 else 1) for i, at in enumerate(order)]


@pytest.mark.parametrize("noise", [0.1, 0.3, 0.5])
def test_vectors_as_by_all_pairs(spark, noise):
    rows = near_rows(int(noise * 10), (2, 3, 9, 40, 120), noise)
    want = plainly.near(rows)
    got = links(sign_dedup.near_vectors(vectors(spark, rows)))
    found = sum(n for n, _, _ in got.values())
    every = sum(n for n, _, _ in want.values())
    assert set(got) == set(want) and all(got[i][0] <= want[i][0] for i in want)
    # Pairs lie on both sides of the limit; the method may miss one in a thousand of those at it.
    assert every > 100 and found >= 0.998 * every
    if found == every:
        assert got == want


def test_buckets_in_parts(spark):
    """A bucket dealt over many parts gives what it gives as a whole."""
    rows = near_rows(3, (150, 30), 0.2)
    assert links(sign_dedup.near_vectors(vectors(spark, rows), part=7)) == plainly.near(rows)


def test_vectors_that_take_no_part(spark):
    one, two = [1.0, 2.0, 3.0], [2.0, 4.0, 6.0]
    rows = [
        (1, one, 5), (2, one, 5), (3, two, 5), (4, one, None), (5, one, 6), (6, None, 5), (7, [], 5), (8, [0.0, 0.0, 0.0], 5),
        (9, [float("nan"), 2.0, 3.0], 5), (10, [None, 2.0, 3.0], 5), (11, [float("inf"), 2.0, 3.0], 5), (12, [1.0, 2.0], 5),
        (13, [1e300, 2e300, 3e300], 5), (14, [1e-300, 2e-300, 3e-300], 5), (15, [-1.0, -2.0, -3.0], 5), (16, [0.0, 0.0, -0.0], 5),
        (17, [0.0, 1.0, 0.0], 6), (18, [-0.0, 1.0, 0.0], 6),
    ]
    got = links(sign_dedup.near_vectors(vectors(spark, rows)))
    assert {i for i, (n, _, _) in got.items() if n} == {1, 2, 3, 13, 14, 17, 18}
    assert all(got[i] == (4, 1, i == 1) for i in (1, 2, 3, 13, 14))
    assert got[17] == (1, 17, True) and got[18] == (1, 17, False)
    assert all(got[i] == (0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 15, 16))


def test_repeated_and_unnamed_vectors(spark):
    rows = [(3, [1.0, 1.0], 1), (3, [1.0, 1.0], 1), (4, [1.0, 1.0], 1), (None, [1.0, 1.0], 1), (None, [5.0, -1.0], 2)]
    got = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in sign_dedup.near_vectors(vectors(spark, rows)).collect()), key=str)
    assert got == [(3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (None, 0, None, True), (None, 2, 3, False)]
    assert sign_dedup.near_vectors(vectors(spark, [])).count() == 0
    assert links(sign_dedup.near_vectors(vectors(spark, [(1, None, None)]))) == {1: (0, 1, True)}


def test_tables_keep_the_promise():
    for bits in (8, 12, 20):
        same = (1 - np.arccos(0.93) / np.pi) ** bits
        assert (1 - same) ** sign_dedup.tables_for(bits) <= sign_dedup.MISS
    assert sign_dedup.code_bits(1) == 8 and sign_dedup.code_bits(10**9) > sign_dedup.code_bits(10**6) > 8


def test_recall_at_the_limit(spark):
    """Pairs just near enough, the hardest ones, are nearly all found."""
    random = np.random.default_rng(11)
    rows = []
    for at in range(1500):
        x, y = random.normal(size=(2, 64))
        x /= np.linalg.norm(x)
        y -= (y @ x) * x
        y *= np.sqrt(1 - 0.9301**2) / np.linalg.norm(y)
        rows += [(2 * at, x.tolist(), 1), (2 * at + 1, (0.9301 * x + y).tolist(), 1)]
    got = links(sign_dedup.near_vectors(vectors(spark, rows).repartition(4)))
    assert sum(n == 1 for n, _, _ in got.values()) >= 0.995 * len(rows)


# Periodic runs

TEXTS = "doc_id long, text string, runs string, n_words int"


def texts(spark, rows):
    return spark.createDataFrame([(doc, text, "r", 9) for doc, text in rows], TEXTS)


def found_runs(df):
    return [(row["doc_id"], [tuple(run) for run in row["runs"]], row["collapsed"]) for row in df.collect()]


def runs_by_numpy(lists):
    ids, lengths = periodic.word_ids([[str(x).encode() for x in w] for w in lists])
    out = [[] for _ in lists]
    for text, *run in zip(*(part.tolist() for part in periodic.runs_of(ids, lengths))):
        out[text].append(tuple(run))
    return out


@pytest.mark.parametrize("letters", [1, 2, 3, 5, 50])
def test_runs_of_random_words(letters):
    """Few words make many runs that overlap, touch and lie in one another."""
    random = np.random.default_rng(letters)
    for _ in range(25):
        lists = [random.integers(0, letters, random.integers(0, 130)).tolist() for _ in range(8)]
        assert runs_by_numpy(lists) == [plainly.runs(w) for w in lists]


def test_runs_of_repeated_blocks():
    """Blocks repeated whole and in part, in one another, and shared by texts."""
    random = np.random.default_rng(2)
    for _ in range(60):
        lists = []
        for _ in range(6):
            w: list = []
            for _ in range(random.integers(1, 5)):
                block = random.integers(0, random.choice([2, 4, 40]), random.integers(1, 20)).tolist()
                if random.random() < 0.3:
                    block = block * int(random.integers(1, 6))
                many = random.integers(1, 9)
                w += (block * int(many))[: max(1, len(block) * many - int(random.integers(0, len(block))))]
                w += random.integers(0, 60, random.integers(0, 4)).tolist()
            lists.append(w)
        assert runs_by_numpy(lists) == [plainly.runs(w) for w in lists]


def test_structured_words():
    fibonacci, thue = ["a", "ab"], [0]
    while len(fibonacci[-1]) < 500:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    while len(thue) < 600:
        thue += [1 - x for x in thue]
    lists = [list(fibonacci[-1]), thue, ["x"] * 700, ["x", "y"] * 333 + ["x"], list("aab" * 90 + "aa" * 50 + "aab" * 70)]
    assert runs_by_numpy(lists) == [plainly.runs(w) for w in lists]


def test_runs_of_edge_texts(spark):
    long = "k " * 40 + " ".join(f"u{i * i % 1009}x{i % 13}" for i in range(30_000)) + " l m" * 5_000
    rows = [
        (1, None), (2, ""), (3, " \t\n "), (4, "a a a a a"), (5, "a a a a a a"), (6, "A a A a A a A a"), (6, "A a A a A a A a"),
        (None, "a b c\ta b c\na b c a b c"), (7, "é é é é é é \x1c"), (8, "a b a b a b a"), (9, long),
    ]
    want = [(doc, plainly.runs(plainly.words(text)), text) for doc, text in rows]
    got = found_runs(periodic.find_runs(texts(spark, rows)))
    assert [(doc, runs) for doc, runs, _ in got] == [(doc, runs) for doc, runs, _ in want]
    assert [left for _, _, left in got[:10]] == ["", "", "", "a a a a a", "a", "A a", "A a", "a b c", "é \x1c", "a b a b a b a"]
    kept = got[10][2].split()
    assert len(kept) == 30_000 + 3 and kept[0] == "k" and kept[-2:] == ["l", "m"]
    assert periodic.find_runs(texts(spark, [])).count() == 0
    assert periodic.find_runs(texts(spark, rows)).columns == ["doc_id", "text", "n_words", "runs", "collapsed"]


def test_longest_run_and_ties(spark):
    df = periodic.find_runs(texts(spark, [(1, "x y x y x y x y z a b a b a b a b"), (2, "a b"), (3, "c c c c c c d e f d e f d e f d e f")]))
    got = {row["doc_id"]: row["best"] for row in df.withColumn("best", periodic.longest_run(F.col("runs"))).collect()}
    assert tuple(got[1]) == (0, 8, 2) and got[2] is None and tuple(got[3]) == (6, 12, 3)


def test_tails(spark):
    rows = [(doc, " ".join(f"w{i}" for i in range(doc % 70))) for doc in range(300)] + [(None, "a b c"), (400, None)]
    got = {row["doc_id"]: row["text"] for row in repeat_tails(texts(spark, rows)).collect()}
    found = {row["doc_id"]: [tuple(r) for r in row["runs"]] for row in periodic.find_runs(repeat_tails(texts(spark, rows))).collect()}
    assert got[None] == "a b c" and got[400] is None
    for doc, text in rows[:300]:
        assert len(found[doc]) == plainly.run_digests(doc, text)[0]
        assert len(got[doc].split()) == doc % 70


# Families of near copies, for the Jaccard join


def test_jaccard_of_families(spark, monkeypatch):
    """Copies around a centre that are not similar to one another, in groups larger than a part."""
    from tallyframe.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "PART", 32)
    monkeypatch.setattr(jaccard_join, "FEW", 10)
    random = np.random.default_rng(5)
    rows = []
    for family, (size, edits) in enumerate(((150, 4), (90, 12), (30, 1))):
        base = [f"f{family}w{at}" for at in range(160)]
        for _ in range(size):
            words = list(base)
            for at in random.integers(0, 160, int(random.integers(0, edits + 1))):
                words[at] = f"x{random.integers(1 << 40)}"
            rows.append((len(rows), " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_components(df).collect()}
    want = plainly.components(rows)
    assert got == want and 3 < len({component for _, component in want.values()}) < 100


# Lexical search

DOCS = "doc_id long, text string, score long, terms int"
ITEMS = "item_id long, text string, item string"


def search(spark, documents, items, **settings):
    df = lexical.search(
        spark.createDataFrame([(doc, text, 1, 2) for doc, text in documents], DOCS).repartition(3),
        spark.createDataFrame([(item, text, "z") for item, text in items], ITEMS), **settings,
    )
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    out: dict = {}
    for row in sorted(df.collect(), key=lambda row: (row["item_id"] or 0, row["rank"])):
        out.setdefault(row["item_id"], []).append((row["doc_id"], row["score"]))
        assert row["rank"] == len(out[row["item_id"]])
    return out


def prose(seed, many):
    random = np.random.default_rng(seed)
    return [" ".join(f"T{x}é" if x % 5 == 0 else f"t{x}" for x in np.minimum(random.zipf(1.3, random.integers(1, 60)), 400)) for _ in range(many)]


@pytest.mark.parametrize("settings", [{}, {"vocabulary_bytes": 300}, {"top": 3}])
def test_search(spark, settings):
    documents = list(enumerate(prose(1, 300)))
    # Copies tie, and ids decide between them.
    documents += [(1000 - doc, text) for doc, text in documents[:80]]
    items = list(enumerate(prose(2, 90)))
    want = plainly.ranked(documents, items, settings.get("top", 50))
    assert search(spark, documents, items, **settings) == {item: found for item, found in want.items() if found}


def test_search_edges(spark):
    documents = [(1, "One, two; THREE"), (2, None), (3, ""), (4, "..."), (None, "one two"), (5, "one two"), (5, "one two"), (6, "ONE É"), (7, "x " * 20_000 + "one")]
    items = [(1, "one two"), (2, None), (3, "!!"), (4, "absent"), (5, "É one"), (6, "é"), (7, "three_THREE")]
    got = search(spark, documents, items)
    want = plainly.ranked(documents, items)
    assert got == {item: found for item, found in want.items() if found}
    assert [doc for doc, _ in got[1]][:4] == [1, 5, 5, None] and set(got) == {1, 5, 7}
    assert search(spark, [], items) == {} and search(spark, documents, []) == {} and search(spark, [(1, None)], items) == {}


def test_repeated_items(spark):
    got = lexical.search(
        spark.createDataFrame([(1, "a b", 1, 2), (2, "c", 1, 2)], DOCS),
        spark.createDataFrame([(9, "a", "x"), (9, "a", "x"), (9, "c", "x")], ITEMS),
    ).collect()
    assert sorted((row["item_id"], row["rank"], row["doc_id"]) for row in got) == [(9, 1, 1), (9, 1, 2)]


def test_partial_sums_are_exact():
    """Products whose sum passes 2^53 are split, and the parts are added as whole numbers."""
    many = 40_000
    terms = np.arange(many)
    weights = np.full(many, 2**21, np.int64) - terms % 7
    tile = lexical.item_tiles([(0, terms)], weights)[0]
    impacts = np.full(many, lexical.MOST_IMPACT - 1, np.int64)
    place = np.full(many, -1, np.int64)
    got = lexical.tile_scores(tile, place, terms, np.zeros(many, np.int64), impacts, 1)
    assert int(got[0, 0]) == sum(int(w) * (lexical.MOST_IMPACT - 1) for w in weights) > 2**53
    assert (place == -1).all()
