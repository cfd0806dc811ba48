"""Near copies of the pipeline against brute-force five-word Jaccard."""

import random

import corpus_pipeline
from plazaflow.llm import near_copies

from . import corpus


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def survivors(rows):
    """Positions of the rows that stay: the smallest id of each component of similarity 0.8 or more."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 10 * len(a & b) >= 8 * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[find(i)] = min(name, least.get(find(i), name))
    return sorted(set(least.values()))


def edited(words, changes, rng):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = "new" + "".join(rng.choices("abcdefgh", k=6))
    return " ".join(out)


def test_near_copies_match_brute_force(spark):
    rng = random.Random(11)
    texts = []
    for n, changes in ((200, 3), (200, 1), (500, 8), (60, 1), (60, 2), (900, 30)):
        for _ in range(6):
            words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(n)]
            texts += [" ".join(words), edited(words, changes, rng), edited(words, changes, rng)]
    texts += [None, "", " \t", "a", "A", "a b", "a b c d", "a b c d e", "a b c d e f"]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    assert sorted(r.doc_id for r in got.collect()) == survivors(rows)


def test_stage_drops_near_copies_that_differ_in_many_bits(spark):
    docs = corpus.documents(spark).where("doc_id IS NOT NULL")
    got = corpus_pipeline.near_dedup(spark, docs, "")
    assert sorted(r.doc_id for r in got.collect()) == survivors([(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect()])


def test_bands_whose_ends_are_no_copies(spark, monkeypatch):
    """One key for all: pairs that meet neither end are found across components."""
    monkeypatch.setattr(near_copies, "_bands", lambda texts: [[1]] * len(texts))
    rng = random.Random(5)
    texts = []
    for _ in range(8):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(80)]
        texts += [" ".join(words), edited(words, 1, rng)]
    rows = list(enumerate(texts))
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1))
    assert sorted(r.doc_id for r in got.collect()) == survivors(rows)


def test_repeated_and_null_ids(spark):
    """Unrelated rows of one id stay; near copies go whether they have an id or not."""
    rng = random.Random(3)
    a, b, c, d = (["".join(rng.choices("abcdefghij", k=6)) for _ in range(100)] for _ in range(4))
    rows = [(1, " ".join(a)), (1, " ".join(b)), (1, " ".join(b)), (2, edited(b, 1, rng)), (None, edited(a, 1, rng)), (None, " ".join(c)), (None, edited(c, 1, rng)), (None, " ".join(c)), (3, " ".join(d))]
    got = near_copies.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    named = sorted((r.doc_id, r.text) for r in got if r.doc_id is not None)
    assert named == sorted([(1, " ".join(a)), (1, " ".join(b)), (3, " ".join(d))])
    assert [r.text for r in got if r.doc_id is None] in ([rows[5][1]], [rows[6][1]])


def test_blocks_of_a_band_meet_each_other(spark, monkeypatch):
    """Bands cut into many small blocks give the components of the whole band."""
    monkeypatch.setattr(near_copies, "_bands", lambda texts: [[1, 2]] * len(texts))
    rng = random.Random(6)
    texts = []
    for _ in range(10):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(80)]
        texts += [" ".join(words), edited(words, 1, rng), edited(words, 2, rng)]
    rows = [(k, t) for k, t in enumerate(texts)]
    nodes = spark.createDataFrame(rows, "node long, text string")
    found = {r.node: r.root for r in near_copies.roots(nodes, near_copies.Scratch(spark), block=4).collect()}
    assert sorted({found.get(k, k) for k, _ in rows}) == survivors(rows)


def test_forest_against_all_pairs():
    rng = random.Random(8)
    texts = []
    for _ in range(15):
        words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(rng.randint(4, 60))]
        texts += [" ".join(words), edited(words, 1, rng), edited(words, 3, rng), " ".join(words[:-2])]
    nodes = near_copies.np.arange(len(texts)) * 7
    roots = near_copies.np.array([x - x % 14 if k % 5 == 0 else x for k, x in enumerate(nodes.tolist())])
    links = near_copies.forest(nodes, roots, near_copies._sets(texts))
    assert len({b for _, b in links}) == len(links)

    def parts(pairs):
        label = {int(n): int(n) for n in nodes}
        while True:
            before = dict(label)
            for a, b in [*pairs, *zip(nodes.tolist(), roots.tolist(), strict=True)]:
                label[a] = label[b] = min(label[a], label[b])
            if before == label:
                return label

    sets = [shingles(t) for t in texts]
    every = [(int(nodes[i]), int(nodes[j])) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 10 * len(a & b) >= 8 * len(a | b)]
    assert parts(links) == parts(every)
