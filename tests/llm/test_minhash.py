"""Near-duplicates where a doc_id is repeated with different texts."""

import random

from ledgerline.llm import minhash


def test_repeated_ids_with_different_texts(spark):
    rng = random.Random(12)
    base = [[f"b{k}_{i}" for i in range(80)] for k in range(12)]

    def near(k: int) -> str:
        words = list(base[k])
        words[rng.randrange(80)] = f"x{rng.random()}"
        return " ".join(words)

    rows = [(k, " ".join(base[k])) for k in range(12)]
    rows += [(100 + k, near(k)) for k in range(12)]
    rows += [(200, near(0)), (200, near(1)), (200, near(1)), (200, None)]  # one id, texts near 0 and 1
    rows += [(3, " ".join(base[4])), (3, " ".join(base[4])), (5, "one two"), (5, "three four"), (105, near(6))]
    rows += [(50, "q w e r t y"), (50, "a s d f g h"), (51, "A  S d f g h"), (49, "z x c v b n"), (51, "z x c v b n")]
    rows += [(300 + i, near(7)) for i in range(40)] + [(300, near(8)), (8, near(9))]  # crowded buckets
    sets = [minhash.shingle_set(minhash.words_of((t or "").encode()), 2) for _, t in rows]
    parent = {i: i for i, _ in rows}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for (i, _), a in zip(rows, sets):
        for (j, _), b in zip(rows, sets):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    want = sorted((i, len(s), root(i) if s else i) for (i, _), s in zip(rows, sets))
    for small in (2, 16):
        got = minhash.near_duplicates(table, width=2, small=small).collect()
        assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
        assert all(r["kept"] == (r["component_id"] == r["doc_id"]) for r in got)
