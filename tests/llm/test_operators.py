"""Each operator against brute force on small tables that hold the awkward cases."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import (byte_bpe, exact_dedup, lattice, licenses, minhash, mixing, pii, quality, substrings,
                            token_counts)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, size long, `_mix` int"
WORDS = "the of and license mit apache general public released under 4111 1111 naïve über ß 日本 don't a".split()


def prose(rng: random.Random, n: int) -> str:
    return "".join(rng.choice(WORDS) + rng.choice([" ", " ", "  ", "\n", ", ", "\t"]) for _ in range(n))


def texts() -> dict[int, str | None]:
    rng = random.Random(3)
    base = [prose(rng, n) for n in (5, 60, 120, 200, 400)]
    passage = prose(rng, 90)
    out: list[str | None] = [None, "", " \n\t", "one", "One", "a b", *base, *base, base[3].replace(" ", "  "), base[3].upper(),
                             base[4][:900] + passage + base[2], base[1] + passage, "xyz" * 400, "ab" * 300 + "c",
                             "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.",
                             "mail a.b@c.example.org x@y", "call +49 (30) 1234-5678 or +1 2", "10.0.0.1 300.1.1.1 1.2.3.4.5.6.7.8",
                             "card 4111 1111 1111 1111, 4111 1111 1111 1112, 12345", "iban DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00",
                             "security 123-45-6789", "plain 123-45-6789", "<|endoftext|> x <|ENDOFTEXT|>", "\x1c\x85    x  　y", "1" * 3000]
    return dict(enumerate(out))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", ["a", "b", None][i % 3], None, True, 1, 2) for i, t in texts().items()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def test_exact_dedup(docs, empty):
    norm = {i: re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for i, t in texts().items()}
    first = {}
    for i, t in sorted(norm.items()):
        first.setdefault(t, i)
    got = by_id(exact_dedup.exact_duplicates(docs, counters=4))  # few counters: heavy and ordinary digests
    for i, t in norm.items():
        r = got[i]
        assert (r["keep_id"], r["group_size"], r["kept"]) == (first[t], sum(x == t for x in norm.values()), first[t] == i)
        assert bytes(r["digest"]) == hashlib.sha256(t.encode()).digest()
    assert sorted(r["doc_id"] for r in exact_dedup.without_copies(docs).collect()) == sorted(first.values())
    assert exact_dedup.without_copies(docs.union(docs)).count() == len(first)
    assert exact_dedup.exact_duplicates(empty).count() == 0


def test_misra_gries_keeps_every_heavy_hitter(spark):
    rng = random.Random(1)
    values = [b"hot"] * 400 + [str(rng.random()).encode() for _ in range(600)]
    rng.shuffle(values)
    rows = spark.createDataFrame([(bytearray(v),) for v in values], "digest binary").repartition(5).withColumn("doc_id", F.lit(1).cast("long"))
    heavy = exact_dedup.heavy_hitters(rows, 1000, counters=8).collect()
    assert [(bytes(r["digest"]), r["group_size"]) for r in heavy] == [(b"hot", 400)]


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(token_counts.VOCABULARY)
    library = Tokenizer.from_file(path)
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in texts().items()}
    for hot in (0, 3, 1 << 18):  # all pre-tokens joined, some, none
        got = by_id(token_counts.token_counts(docs, path, hot_rows=hot))
        assert {i: r["n_tokens"] for i, r in got.items()} == want
    assert got[0]["n_bytes"] == 0
    assert token_counts.token_counts(docs.union(docs), path).count() == 2 * len(want)
    assert token_counts.token_counts(empty, path).count() == 0


def test_byte_bpe_round_trip(docs, empty):
    import tiktoken

    codec = byte_bpe.codec_of()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    got = by_id(byte_bpe.decode(byte_bpe.encode(docs, codec, offsets=True), codec))
    for i, t in texts().items():
        t = t or ""
        ids = np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist()
        assert ids == own.encode_ordinary(t) and got[i]["n_tokens"] == len(ids)
        assert bytes(got[i]["decoded"]) == t.encode()
        assert "".join(codec.token_texts(bytes(got[i]["ids"]))) == t
        assert all(a <= b for a, b in zip(got[i]["starts"], got[i]["ends"])) and (not ids or got[i]["ends"][-1] == len(t))
        pieces = own.decode_tokens_bytes(ids)
        assert got[i]["n_split"] == sum(not valid(p) for p in pieces)
        for piece, a, b in zip(pieces, got[i]["starts"], got[i]["ends"]):
            assert t[a:b].encode().find(piece) >= 0 and t[a + 1:b - 1].encode() in piece
    once = by_id(byte_bpe.encode(docs, codec, decoded=True))
    assert all((once[i]["ids"], once[i]["decoded"]) == (r["ids"], r["decoded"]) for i, r in got.items()) and len(once) == len(got)
    assert byte_bpe.encode(empty, codec, decoded=True).count() == 0


def valid(piece: bytes) -> bool:
    try:
        return piece.decode() is not None
    except UnicodeDecodeError:
        return False


def test_byte_bpe_clashing_repeated_and_very_long(spark):
    import tiktoken

    codec = byte_bpe.codec_of()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    words = random.Random(3).choices(["the", "naïve", "日本", "x" * 80, "1234", "it's", "\U0001F600"], k=200_000)
    texts_ = ["".join(words[:2000]), " ".join(words), "same", "same", "=" * 100_000]
    df = spark.createDataFrame([(1, t, 5, "k") for t in texts_], "doc_id long, text string, ids int, `a.b` string")
    got = byte_bpe.encode(df, codec, keep=["doc_id", "a.b"], decoded=True)
    assert got.columns == ["doc_id", "a.b", "n_tokens", "n_split", "ids", "decoded"]
    assert sorted((bytes(r["decoded"]).decode(), np.frombuffer(bytes(r["ids"]), "<u4").tolist()) for r in got.collect()) == sorted((t, own.encode_ordinary(t)) for t in texts_)
    with pytest.raises(ValueError, match="ids"):
        byte_bpe.encode(df, codec, keep=["ids"])


def test_byte_bpe_cuts_like_the_library():
    import tiktoken

    rng = random.Random(5)
    codec = byte_bpe.codec_of()
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS)), special_tokens={})
    alphabet = list("aB1' .!\n\t\r\x0b\x1c\x1f\x85\xa0 　é日\U0001F600'")
    strings = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for text, (ids, _, _) in zip(strings, codec.encoder()(strings)):
        assert np.frombuffer(ids, "<u4").tolist() == own.encode_ordinary(text), repr(text)


def shingles(text: str | None, width: int) -> set:
    return minhash.shingle_set(minhash.words_of((text or "").encode()), width)


def test_min_max_near_duplicates(spark, docs, empty):
    rng, rows = random.Random(9), list(texts().items())
    passage = [f"p{i}" for i in range(30)]
    for i in range(120):  # near-copies, and texts that share a passage only
        words = [f"w{k}" for k in range(100)] if i % 2 else passage + [f"v{i}_{k}" for k in range(60)]
        for _ in range(rng.randint(0, 8)):
            words[rng.randrange(len(words))] = f"x{rng.random()}"
        rows.append((1000 + i, " ".join(words)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: shingles(t, 2) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    for small in (2, 16):  # crowded buckets of any size, and ordinary ones
        got = by_id(minhash.near_duplicates(table, width=2, small=small))
        assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
        assert {i: r["component_id"] for i, r in got.items()} == {i: root(i) for i in sets}
        assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())
    assert minhash.near_duplicates(empty).count() == 0


def test_lattice(spark):
    rng = np.random.default_rng(4)
    v = rng.normal(size=(60, 16)).astype("float32")
    near = [v[i % 5] + rng.normal(size=16).astype("float32") * s for i in range(60) for s in (0.05, 0.2, 0.3)]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate([*v, *near, v[0], v[0], v[0] * 2])]
    n = len(rows)
    rows += [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, [None] * 16), (n + 4, []), (n + 5, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n_links", F.lit("clash"))
    x = np.array([np.float32(r) for _, r in rows[:n]], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    link = (x @ x.T >= 0.95) & ~np.eye(n, dtype=bool)
    label = np.arange(n)
    for _ in range(n):
        label = np.array([min(label[i], *label[link[i]]) if link[i].any() else label[i] for i in range(n)])
    for block, plan in ((2048, lattice.PLANS[2]), (3, None)):
        got = by_id(lattice.near_vectors(table, plan=plan, block=block), "vec_id")
        assert [got[i]["n_links"] for i in range(n)] == link.sum(1).tolist()
        assert [got[i]["component_id"] for i in range(n)] == label.tolist()
        assert all(got[i]["n_links"] == 0 and got[i]["component_id"] == i and got[i]["kept"] for i in range(n, n + 6))
    again = by_id(lattice.near_vectors(table.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))), "vec_id")
    assert all(again[i]["component_id"] == label[i] for i in range(n))
    assert lattice.near_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("plan", lattice.PLANS)
def test_lattice_recall_at_the_threshold(plan):
    rng = np.random.default_rng(6)
    a, b = rng.normal(size=(2, 4000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    cells = lattice.Lattice(64, plan)
    ka, kb = cells.keys(a), cells.keys(0.95 * a + np.sqrt(1 - 0.95 ** 2) * b)
    meet = np.concatenate([(x[:, :, :, None] == y[:, :, None, :]).any((1, 2, 3)) for x, y in zip(np.split(ka, 20), np.split(kb, 20))])
    assert meet.mean() > 0.999


def test_lattice_cells_are_the_same_for_tables_of_any_size(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(lattice, "plan_for", lambda rows: lattice.PLANS[1 if rows > 3 else 0])  # a switch, if asked
    monkeypatch.setattr(lattice, "cells", lambda classes, plan, seed, make=lattice.cells: plans.append(plan) or make(classes, plan, seed))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(np.random.default_rng(8).normal(size=(6, 16)))]
    for n in (2, 6):
        lattice.near_vectors(spark.createDataFrame(rows[:n], "vec_id long, embedding array<double>")).collect()
    assert plans == [lattice.PLAN] * 2


def test_smallest_shared_cell_of_pairs():
    x = np.random.default_rng(9).normal(size=(40, 16))
    units = lattice.unit_rows(np.vstack([x, x + np.repeat([[0.02], [0.1], [0.3], [0.5]], 10, 0)]))
    maker = lattice.Lattice(16, lattice.PLAN)
    own, keys = [set(k.ravel().tolist()) for k in maker.keys(units)], lattice.distinct_keys(maker, units)
    met = [(i, 40 + i, c, c == min(own[i] & own[40 + i])) for i in range(40) for c in own[i] & own[40 + i]]
    a, b, cell, expected = (np.array(v) for v in zip(*met))
    for step in (7, 20_000):
        assert (lattice.smallest_shared(keys, a, b, cell, step) == expected).all()
    assert lattice.smallest_shared(keys, a[:0], b[:0], cell[:0]).shape == (0,)


def test_lattice_plans_keep_cells_small():
    for n in (10, 10 ** 4, 10 ** 5, 10 ** 6, 10 ** 8, 10 ** 10):
        assert lattice.plan_for(n).meet * n <= lattice.MEETINGS
    x = lattice.unit_rows(np.random.default_rng(7).normal(size=(20_000, 64)))
    for plan in lattice.PLANS[:4]:
        keys = np.sort(lattice.Lattice(64, plan).keys(x).reshape(len(x), plan.tables, -1), axis=2)
        met = sum((c * (c - 1.0)).sum() for c in (np.unique(keys[:, t], return_counts=True)[1] for t in range(plan.tables)))
        assert met / len(x) ** 2 < 2 * plan.meet


def test_repeated_substrings(docs, empty):
    raw, least = {i: (t or "").encode() for i, t in texts().items()}, 40
    seen = collections.Counter(t[s:s + least] for t in raw.values() for s in range(len(t) - least + 1))
    for strings, heavy in (((16, 32, None), 1 << 22), ((16, 32, None), 1), ((None,), 1 << 22)):  # one level, all levels, windows alone
        got = by_id(substrings.remove_repeats(docs, least, strings, 1 << 12, heavy))
        for i, t in raw.items():
            gone = np.zeros(len(t) + least, bool)
            for s in range(len(t) - least + 1):
                if seen[t[s:s + least]] > 1:
                    gone[s:s + least] = True
            gone = gone[:len(t)]
            assert bytes(got[i]["kept"]) == bytes(c for c, g in zip(t, gone) if not g), i
            assert len(got[i]["spans"]) == int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
    assert substrings.remove_repeats(empty).count() == 0


def test_licenses(docs, empty):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    got = by_id(licenses.license_scan(docs))
    vocabulary = {k: set(licenses.template_words(v)) for k, v in licenses.TEMPLATES.items()}
    step = max(len(licenses.template_words(v)) for v in licenses.TEMPLATES.values())
    for i, t in texts().items():
        words = word.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        assert got[i]["n_words"] == len(words)
        for label, phrase in licenses.PHRASES.items():
            assert got[i]["base"][label] == [k for k in range(len(words)) if words[k:k + len(phrase)] == phrase]
        for label, of in vocabulary.items():
            best = max([len(of & set(words[s:s + 2 * step])) for s in range(0, max(len(words), 1), step)])
            assert got[i]["containment"][label] == pytest.approx(best / len(of) if best >= 0.8 * len(of) - 1e-9 else 0.0), (i, label)
    assert licenses.license_scan(empty).count() == 0


def luhn(digits: str) -> bool:
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def test_pii(docs, empty):
    got = by_id(pii.pii_spans(docs))
    for i, t in texts().items():
        want = []
        for rank, (kind, pattern) in enumerate(pii.PLAIN.items()):
            for m in re.finditer(pattern, t or ""):
                digits = re.sub("[^0-9]", "", m[0])
                good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                        "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]
                if good:
                    want.append((m.start(), rank, m.end(), kind))
        assert [(s["start"], s["rank"], s["end"], s["kind"]) for s in got[i]["spans"] if s["rank"] < 4] == sorted(want), i
    kinds = lambda text: [s["kind"] for s in got[next(i for i, t in texts().items() if t == text)]["spans"]]
    assert kinds("security 123-45-6789") == ["ssn"] and kinds("plain 123-45-6789") == []
    assert [k for k in kinds("iban DE89 3704 0044 0532 0130 00 and DE88 3704 0044 0532 0130 00") if k == "iban"] == ["iban"]
    assert pii.pii_spans(empty).count() == 0


def test_pii_iban_ends_and_context_on_both_sides(spark):
    # Text and the spans to find, as (kind, piece of the text).
    cases = [("IBAN BE68 5390 0754 7034 BIC GKCCBEBB", [("iban", "BE68 5390 0754 7034")]),
             ("AT61 1904 3002 3457 3201 BIC BKAUATWW", [("iban", "AT61 1904 3002 3457 3201")]),
             ("AT611904300234573201 BIC BKAUATWW", [("iban", "AT611904300234573201")]),
             ("ES91 2100 0418 4502 0005 1332 SWIFT X", [("iban", "ES91 2100 0418 4502 0005 1332")]),
             ("BE68 5390 0754 7034 AT611904300234573201 NO93 8601 1117 947", [("iban", "BE68 5390 0754 7034"), ("iban", "AT611904300234573201"), ("iban", "NO93 8601 1117 947")]),
             ("MT84 MALT 0110 0001 2345 MTLC AST0 01S IBAN", [("iban", "MT84 MALT 0110 0001 2345 MTLC AST0 01S")]),
             ("ref AB13 BE68 5390 0754 7034 end", [("iban", "BE68 5390 0754 7034")]),
             ("ref AB12 BE68 5390 0754 7034 end", [("iban", "AB12 BE68 5390 0754 7034"), ("iban", "BE68 5390 0754 7034")]),  # no such country, but mod-97 holds
             ("DE89 3704 0044 0532 0130 00, DE88 3704 0044 0532 0130 00", [("iban", "DE89 3704 0044 0532 0130 00")]),
             ("BE68 5390 0754 7034x BE68 5390 0754 70341", []),
             ("XX07 5390 0754 7034 BIC", [("iban", "XX07 5390 0754 7034")]),
             ("SSN 123-45-6789, 234-56-7890", [("ssn", "123-45-6789"), ("ssn", "234-56-7890")]),
             ("é日 123-45-6789 is the social number", [("ssn", "123-45-6789")]),
             ("123-45-6789, 234-56-7890 (SSN)", [("ssn", "123-45-6789"), ("ssn", "234-56-7890")]),
             ("SSN" + " ." * 30 + " 123-45-6789" + " ." * 30 + " SSN", [])]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")
    got = by_id(pii.pii_spans(docs))
    for i, (t, want) in enumerate(cases):
        assert [(s["kind"], t[s["start"]:s["end"]]) for s in got[i]["spans"] if s["kind"] in ("iban", "ssn")] == want, t
    both = [s["score"] for s in by_id(pii.pii_spans(spark.createDataFrame([(1, "a@b.cd is my mail, x@y.zw")], "doc_id long, text string")))[1]["spans"]]
    assert both == [1.0, 1.0]


def test_quality_learns_and_scores_everything(spark, empty):
    rng = random.Random(11)
    rows, labels = [], []
    for i in range(900):
        good = rng.random() < 0.7
        body = prose(rng, rng.randint(20, 80))
        rows.append((i, body if good else re.sub(" ", "### $$ ", body.upper()), "x" if good else "y"))
        labels.append((i, int(good), 0))
    rows += [(900, None, "x"), (901, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    truth = spark.createDataFrame([*labels, (5, 1, 0), (None, 1, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    got = by_id(quality.score(docs, quality.fit(docs, truth), out="p"))
    assert len(got) == 902 and all(0 <= r["p"] <= 1 for r in got.values()) and got[900]["p"] == got[901]["p"]
    held = [i for i in range(900) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i]["p"] >= 0.5) == (rows[i][2] == "x") for i in held]) > 0.97
    nothing = quality.fit(docs, truth.limit(0))
    assert {r["p"] for r in quality.score(docs, nothing, out="p").collect()} == {0.5}
    assert quality.score(empty.select("doc_id", "text"), nothing).count() == 0


def test_isotonic_fit_is_monotone():
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    at, share = quality.isotonic(x, (x + rng.normal(size=500) > 0).astype(float))
    assert (np.diff(at) > 0).all() and (np.diff(share) > 0).all()


def test_mix_meets_targets_and_caps(spark, empty):
    rng = random.Random(8)
    rows = [(i, " ".join(["w"] * rng.randint(1, 20)), rng.choice(["a", "a", "a", "a", "b", None]), 5) for i in range(1500)]
    rows += [(5000, None, "b", 5), (5001, "   ", "only blank", 5), (5002, "x y", "tiny", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    got = mixing.mix(docs).select("doc_id", "source", "_mix.*").collect()
    total = sum(r["size"] for r in got)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert sum(t for t, _ in targets.values()) == pytest.approx(total)
    weights = {s: (1, 2, 3)[k % 3] for k, s in enumerate(sorted(targets, key=lambda s: (s is None, s or "")))}
    share = {s: 0.0 for s in targets}  # reshare the excess until nothing is above its cap
    free, left = set(targets), float(total)
    while free:
        part = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if part[s] > 3 * targets[s][1]}
        share.update(part)
        if not over:
            break
        for s in over:
            share[s] = 3.0 * targets[s][1]
            left -= share[s]
        free -= over
    assert {s: t for s, (t, _) in targets.items()} == pytest.approx(share)
    for s, (t, _) in targets.items():
        assert abs(sum(r["taken"] for r in got if r["source"] == s) - t) <= 20
    assert all(r["taken"] <= 3 * r["size"] and r["positions"] == sorted(r["positions"]) and len(r["positions"]) == r["copies"] for r in got)
    again = mixing.mix(docs.repartition(7)).select("doc_id", "_mix.taken").collect()
    assert {r["doc_id"]: r["taken"] for r in again} == {r["doc_id"]: r["taken"] for r in got}
    assert mixing.curriculum(docs).count() == sum(r["copies"] for r in got)
    assert mixing.mix(empty.drop("_mix")).count() == 0
