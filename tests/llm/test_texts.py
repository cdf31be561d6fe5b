"""Duplicate removal, leaks and packing against brute force, with nulls, repeats, ties and empty tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, jaccard, packing, substring

SCHEMA = "doc_id long, text string, spans string, row string"


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Texts with copies, near copies, a shared passage, tiny sets, nulls, empties; clashing extra columns."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(30)]
    rows: list[list[str]] = []
    for i in range(n):
        kind = i % 6
        if kind == 0 or len(rows) < 6:
            own = [rng.choice(words) for _ in range(rng.randint(20, 200))]
        elif kind == 1:
            own = list(rng.choice(rows))
        elif kind == 2:
            own = [w if rng.random() > 0.015 else rng.choice(words) for w in rng.choice(rows)]
        elif kind == 3:
            own = [rng.choice(words) for _ in range(40)] + passage + [rng.choice(words) for _ in range(40)]
        elif kind == 4:
            own = [rng.choice(words[:3]) for _ in range(rng.randint(1, 14))]
        else:
            own = [rng.choice(words) for _ in range(15)] * 3
        rows.append(own)
    out = [(i * 3, (" " if i % 2 else " \n\t").join(r), "x", None) for i, r in enumerate(rows)]
    out += [(1000, None, None, None), (1001, "", None, None), (1002, " \n ", None, None), (None, out[0][1], None, None), (9, out[3][1], "again", None), (1003, "a" * 50_000 + " " + "b c d e f g h i j k l m n o " * 30, None, None)]
    rng.shuffle(out)
    return out


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_substring(rows, n=13):
    docs = [(i, words_of(t)) for i, t, *_ in rows]
    first = {}
    for i, w in docs:
        if i is not None:
            for j in range(len(w) - n + 1):
                key = tuple(w[j : j + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - n + 1):
            if i is not None and first[tuple(w[j : j + n])] < i:
                gone[j : j + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_substring_matches_brute_force(spark):
    rows = corpus()
    got = substring.remove_repeats(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("h"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_substring(rows)


def test_substring_rows_keep_columns_and_empty_table(spark):
    df = spark.createDataFrame(corpus(2, 20), SCHEMA)
    cut = substring.cut_rows(df)
    assert cut.columns == df.columns and cut.count() == df.count()
    assert substring.remove_repeats(df.where("false")).count() == 0


def test_automaton_knows_every_substring():
    rng = random.Random(3)
    rows = [[rng.randint(0, 3) for _ in range(rng.randint(1, 40))] for _ in range(12)]
    a = substring.SuffixAutomaton()
    owners = list(range(100, 112))
    rng.shuffle(owners)
    for words, owner in zip(rows, owners):
        a.add(words, owner)
    a.finish()
    for n in (1, 3, 6):
        for q in [*rows, [rng.randint(0, 4) for _ in range(60)]]:
            want = []
            for j in range(len(q) - n + 1):
                found = [o for w, o in zip(rows, owners) if any(w[k : k + n] == q[j : j + n] for k in range(len(w) - n + 1))]
                want.append(min(found) if found else None)
            assert a.smallest_owners(q, n) == want


def brute_jaccard(rows, n=5):
    sets = {}
    for i, t, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + n]) for j in range(max(1, len(w) - n + 1))) if w else frozenset())
    ids = [i for i in sets if i is not None]
    low = {i: i for i in ids}
    changed = True
    links = [(a, b) for a in ids for b in ids if a < b and any(100 * len(x & y) >= 80 * len(x | y) for x in sets[a] for y in sets[b] if x and y)]
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return sorted(((i, len(s), low.get(i)) for i, own in sets.items() for s in own), key=str)


@pytest.mark.parametrize("hot", [128, 2])
def test_jaccard_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(jaccard, "HOT_LIST", hot)
    rows = corpus(4, 70) + [(2000 + i, " ".join(f"k{j}" for j in range(i % 5, 9 + i % 5)), None, None) for i in range(12)]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_jaccard(rows)


def test_jaccard_ids_with_several_texts(spark):
    one, two = (" ".join(f"{k}{j}" for j in range(60)) for k in "ab")
    rows = [(1, one), (5, one), (5, two), (8, two), (9, two + " more"), (20, "c d e f g h i j"), (21, "c d e f g h i j"), (21, "p q r s t u v w x y z"), (22, "p q r s t u v w x y z a")]
    got = jaccard.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_jaccard(rows)
    assert {r["doc_id"]: r["component_id"] for r in got.collect()} == {1: 1, 5: 1, 8: 1, 9: 1, 20: 20, 21: 20, 22: 20}


def test_jaccard_empty_table_and_subset_sizes(spark):
    assert jaccard.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    for a in range(1, 15):  # linked small sets share an enumerated subset size
        for b in range(a, int(a / 0.8) + 1):
            assert set(jaccard.subset_sizes(a)) & set(jaccard.subset_sizes(b))


def test_leaks_verbatim_reparameterised_and_clean(spark):
    item = "Every morning the farmer named Alice Brown carries 12 baskets of ripe apples over 3 km to the market and sells 7 of them before noon."
    changed = item.replace("12", "45").replace("Alice", "Maria").replace("Brown", "Stone").replace("3 km", "8 miles").replace("7", "20")
    broken = "Said " + item.replace("Alice Brown", "Maria Maria")
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "too short"), (5, item.split(" and ")[0])], "item_id long, text string")
    rows = [(1, f"intro words {item} end"), (2, f"so: {changed}"), (3, "nothing to see " * 40), (4, None), (5, ""), (6, broken), (None, item), (1, item)]
    got = decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench, block_bytes=200)
    found = [(r["doc_id"], sorted(x["item_id"] for x in r["leaks"]), max([x["changed"] for x in r["leaks"]], default=0)) for r in got.collect()]
    by = {i: (items, n) for i, items, n in found if i not in (1, None)}
    assert by[2][0] == [1, 5] and by[2][1] >= 4
    assert by[3] == by[4] == by[5] == ([], 0)
    assert 1 not in by[6][0] or by[6][1] == 0  # two names cannot stand for one
    assert sum(1 for i, items, _ in found if i in (1, None) and 1 in items) == 3
    assert decontaminate.find_leaks(spark.createDataFrame(rows, "doc_id long, text string"), bench.where("false")).where("size(leaks) > 0").count() == 0


def leaks_of(items, text):
    index = decontaminate.Index(list(enumerate(items, 1)), 13).open()
    return {i: x for i, *x in index.leaks([text.encode().split()], decontaminate.Templates())[0]}


def test_leaks_beside_a_conflict():
    item = "Every morning the farmer named Alice Brown carries 12 baskets of ripe apples over 3 km to the market and sells 7 of them before noon."
    assert leaks_of([item, item.split(" and ")[0]], "Said " + item.replace("Alice Brown", "Maria Maria")) == {1: [19, 8, 0]}
    assert leaks_of([item], item.replace("12", "45").replace("7", "45")) == {1: [21, 0, 1]}  # up to the second 45
    twice = "near the old mill Tom bakes bread for the whole village every day and in the long dark winter then Tom sleeps until noon because nobody buys bread in the deep snow"
    assert leaks_of([twice], twice.replace("Tom", "Bob", 1).replace("Tom", "Ann")) == {1: [27, 5, 1]}


def test_leaks_of_slots_and_short_items_are_verbatim():
    items = ["1 2 4 8 16 32 64 128 256 512 1024 2048 4096 8192 16384", "Paris London Berlin Madrid Rome Vienna", "two words", "2 + 2 = 4", "***"]
    assert leaks_of(items, f"so {items[0]} and {items[1]} with two words, 2 + 2 = 4 end ## two words") == {1: [15, 1, 0], 2: [6, 17, 0], 3: [2, 33, 0], 4: [5, 26, 0]}
    assert leaks_of(items, "so 1 2 4 8 16 32 64 129 256 512 1024 2048 and Oslo London Berlin Madrid Rome Vienna with 3 + 3 = 6 or two other words") == {}


def test_leaks_do_not_depend_on_the_word_before():
    words = "The train leaves the station for the coast at noon with 5 cars".split()
    for n in range(6, 14):
        item = " ".join(words[:n])
        for text in (f"intro words {item} end", f"intro: {item} end", item):
            assert leaks_of([item], text)[1][::2] == [n, 0]
    assert leaks_of([" ".join(words) + ". Nobody sees it go"], "intro words " + " ".join(words))[1][::2] == [13, 0]
    item = "Alice has 3 apples and eats one. Carl sees it."
    for text in ("Bob has 4 apples and eats one. Dave sees it.", "so Bob has 4 apples and eats one. Carl sees it.", "So. Bob has 4 apples and eats one: carl sees it."):
        assert leaks_of([item], text)[1][0] == 10
    assert leaks_of([item], "Bob has 4 pears and eats one. Dave sees it.") == {}


def longest_leak(item, text, n):
    """Most words that item and text share along one shift, numbers standing for numbers one to one, in at least min(n, all) words; else 0."""
    size, best = min(n, len(item)), 0
    for i in range(len(item)):
        for j in range(len(text)):
            forth, back = {}, {}
            for length, (a, b) in enumerate(zip(item[i:], text[j:]), 1):
                both = a.isdigit() and b.isdigit()
                if (not both and a != b) or (both and (forth.setdefault(a, b) != b or back.setdefault(b, a) != a)):
                    break
                if length >= size:
                    best = max(best, length)
    return best


@pytest.mark.parametrize("seed", range(4))
def test_leaks_equal_brute_force(spark, seed):
    rng = random.Random(seed)

    def some(length):
        numbers = rng.randrange(3)
        return [str(rng.randint(1, 3)) if k % 3 == numbers else rng.choice(["red", "sun", "oak"]) for k in range(length)]

    items = [(i, some(rng.randint(5, 11))) for i in range(12)]
    texts = [(i, some(rng.randint(0, 60))) for i in range(60)]
    texts += [(100 + i, [*some(4), *item, *some(3)]) for i, item in items]
    texts.append((7, texts[7][1]))  # a repeated row is judged alike
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts], "doc_id long, text string")
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    for block_bytes in (10**6, 500):
        got = sorted((r["doc_id"], sorted((x["item_id"], x["words"]) for x in r["leaks"])) for r in decontaminate.find_leaks(docs, bench, 5, block_bytes).collect())
        want = sorted((i, sorted((k, w) for k, item in items if (w := longest_leak(item, t, 5)))) for i, t in texts)
        assert got == want and any(found for _, found in want) and not all(found for _, found in want)


def check_packing(pieces, capacity):
    by = {}
    for p in pieces:
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_packing_covers_everything(spark):
    from tokenizers import Tokenizer

    rows = [(i, t) for i, t, *_ in corpus(5, 40)] + [(7777, "It's <|endoftext|> ÉTÉ naïve 12.5km!! “x” ß " * 9)]
    got = packing.pack_documents(spark.createDataFrame(rows, "doc_id long, text string"), capacity=256, with_ids=True).collect()
    n = check_packing(got, 256)
    rooms = []
    for length in sorted((p["length"] for p in got), reverse=True):  # plain best-fit decreasing needs no fewer
        fit = min((r for r in rooms if r >= length), default=None)
        if fit is None:
            rooms.append(256 - length)
        else:
            rooms[rooms.index(fit)] = fit - length
    assert n <= len(rooms)
    encoder = Tokenizer.from_file(packing.default_tokenizer())
    want = sorted((str(i), *encoder.encode(t or "", add_special_tokens=False).ids, 1) for i, t in rows)
    texts, last = [], {}
    for p in sorted(got, key=lambda p: (str(p["doc_id"]), p["start"])):
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and p["length"] == len(p["ids"])
        last.setdefault(str(p["doc_id"]), []).append(p)
    once = [(i, own) for i, own in last.items() if sum(1 for j, _ in rows if str(j) == i) == 1]
    texts = sorted((i, *[x for p in own for x in p["ids"]]) for i, own in once)
    assert texts == [w for w in want if w[0] in dict(once)]
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_whole_text_vocabulary_is_not_cut_into_chunks():
    import public_tokenizers

    m = packing.ChunkIds(public_tokenizers.path("byte_bpe_50k.json"))
    assert not m.by_chunk
    text = "Two  words,\n three."
    assert np.frombuffer(b"".join(m.encoded([m.split(text.encode())])[0]), "<u4").tolist() == m.encoder.encode(text, add_special_tokens=False).ids


def test_ids_of_random_strings_are_those_of_whole_texts():
    rng = random.Random(11)
    letters = [*"aAbZzéÉİıſßẞKÅσΣςǅŉΐﬁ%.,;:!?*&$#'’st|<>_-0१½ \n\t", "\u0085", "\u0327", "\u0338", "\u0301", "\u3000", "你", "हि", "א", "😀", "\u200d", "'s", "'re", "<|endoftext|>", "<|", "|>", "İ%", "e\u0301", "straße"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 14))) for _ in range(20_000)] + ["İ% hello", "x" * 5000, "%" * 3000]
    m = packing.ChunkIds(packing.default_tokenizer())
    assert m.by_chunk and m.by_stem and m.by_merges
    for lo in range(0, len(texts), 256):
        some = texts[lo : lo + 256]
        for t, ids in zip(some, m.encoded([m.split(t.encode()) for t in some])):
            assert np.frombuffer(b"".join(ids), "<u4").tolist() == m.encoder.encode(t, add_special_tokens=False).ids, t


def test_patterns_place_most_pieces():
    rng = random.Random(8)
    histogram = {}
    for _ in range(4000):
        k = min(4096, int(rng.expovariate(1 / 900)) + 1)
        histogram[k] = histogram.get(k, 0) + 1
    chosen = packing.fitted(histogram, 4096)
    assert all(sum(p) <= 4096 for p in chosen) and sum(n * len(p) for p, n in chosen.items()) > 2000
    assert sum(n for _, n in packing.plan(histogram, 4096)) <= -(-sum(k * n for k, n in histogram.items()) // 4096) + 1


def test_plan_uses_every_length_once():
    rng = random.Random(6)
    histogram = {}
    for _ in range(3000):
        k = min(100, int(rng.expovariate(1 / 30)) + 1)
        histogram[k] = histogram.get(k, 0) + 1
    used = {}
    n = 0
    for pattern, repeats in packing.plan(histogram, 100):
        assert sum(pattern) <= 100 and repeats > 0
        n += repeats
        for length in pattern:
            used[length] = used.get(length, 0) + repeats
    assert used == histogram
    assert n <= -(-sum(k * v for k, v in histogram.items()) // 100) + 2
