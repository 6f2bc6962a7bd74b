"""Near duplicates, decontamination, language models and languages, by brute force."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from brute import words_of
from pyspark.sql import functions as F

from sparktrips.llm import decontaminate, jaccard_join, language_id, lm_scoring
from sparktrips.llm.common import Memo, Words

SF = "/root/testdata/sf0.001"


def shingles(text: str | None) -> frozenset:
    w = words_of(text)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def groups(sets: list[frozenset]) -> list[int]:
    """The component of each set, by testing all pairs."""
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(sets))]


def check_groups(docs) -> None:
    rows = docs.select("doc_id", "text").collect()
    sets = [shingles(r.text) for r in rows]
    of, least = groups(sets), defaultdict(list)
    for r, g, s in zip(rows, of, sets):
        if r.doc_id is not None:
            least[g].append(r.doc_id)
    expected = sorted((str(r.doc_id), len(s), str(min(least[g]) if s and least[g] else r.doc_id)) for r, s, g in zip(rows, sets, of))
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in jaccard_join.near_duplicates(docs).collect())
    assert got == expected


@pytest.mark.parametrize("table", ["documents", "awkward", "nothing"])
def test_components(request, table):
    check_groups(request.getfixturevalue(table))


def edited(rng: random.Random, words: list[str], edits: int) -> list[str]:
    words = list(words)
    for _ in range(edits):
        i = rng.randrange(len(words))
        kind = rng.randrange(3)
        words[i:i + 1] = [] if kind == 0 else [f"new{rng.randrange(10**6)}"] if kind == 1 else [words[i], f"new{rng.randrange(10**6)}"]
    return words


def test_components_at_every_size_and_in_large_groups(spark):
    """Sizes around the band edges, similarities around 3/4, one large group of near
    copies, and a passage that many otherwise different texts share."""
    rng = random.Random(5)
    rows: list[str] = []
    for size in [3, 4, 5, 6, 7, 8, 9, 11, 13, 20, 31, 32, 40, 64, 80, 113, 114, 115, 150, 203, 204, 260, 360, 700]:
        base = [f"w{rng.randrange(10**6)}" for _ in range(size + 4)]
        rows += [" ".join(base), " ".join(base[: max(1, int(size * 0.76))]), " ".join(base + [f"z{i}" for i in range(size // 3)])]
        rows += [" ".join(edited(rng, base, e)) for e in (1, max(1, size // 60), max(1, size // 36), max(1, size // 30))]
    base = [f"c{i}" for i in range(120)]
    rows += [" ".join(edited(rng, base, rng.choice([1, 2, 3, 4]))) for _ in range(120)]
    passage = [f"p{i}" for i in range(30)]
    rows += [" ".join(passage + [f"q{rng.randrange(10**6)}" for _ in range(rng.choice([1, 3, 6, 9, 40]))]) for _ in range(80)]
    check_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5))


def test_sketch_bounds_the_difference():
    rng = random.Random(2)
    texts = [" ".join(edited(rng, [f"w{i}" for i in range(n)], e)).encode() for n in (30, 90, 300) for e in (0, 1, 2, 5)]
    sets = jaccard_join.Sets(texts)
    own = [set(sets.hashes[a:b].tolist()) for a, b in zip(sets.first, sets.first[1:])]
    for words in (2, 16, 64):
        bits, ends = sets.bit_sketches(np.full(len(texts), words))
        sketches = bits.reshape(-1, words)
        half = sets.bit_sketches(np.full(len(texts), words // 2))[0].reshape(-1, words // 2)
        assert ends[-1] == len(bits) and (jaccard_join.folded(bits, ends, max(1, words // 4)).reshape(len(texts), -1).shape[1] == max(1, words // 4))
        assert (half == sketches[:, :words // 2] ^ sketches[:, words // 2:]).all()
        for i, a in enumerate(own):
            for j, b in enumerate(own):
                assert sum(int(x).bit_count() for x in sketches[i] ^ sketches[j]) <= len(a ^ b)


def test_long_paths_are_one_component(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 60) if i != 30] + [(100, 7), (200, 201)], "a bigint, b bigint")
    got = dict(jaccard_join.components(edges).distinct().collect())
    assert {n for n, c in got.items() if c == 0} == {*range(31), 100} and {n for n, c in got.items() if c == 31} == set(range(31, 61))
    assert got[201] == 200


def distance(a: list, b: list) -> int:
    """Least edit distance between ``a`` and a prefix of ``b``."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def plain_words(text: str) -> list[bytes]:
    return Words([text.encode()], decontaminate.SEPARATOR).hashes.tolist()


def test_exact_copies_are_all_found_and_clean_texts_left(documents, spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(documents, items).collect()}
    texts, wanted = documents.collect(), {r.item_id: plain_words(r.text) for r in items.collect()}
    for d in texts:
        w = plain_words(d.text)
        for k, item in wanted.items():
            exact = any(w[i:i + len(item)] == item for i in range(len(w)) if w[i] == item[0])
            assert exact == ((d.doc_id, k) in got and got[d.doc_id, k].distance == 0)
    for (doc, k), r in got.items():
        w = plain_words(next(d.text for d in texts if d.doc_id == doc))
        most = int(0.2 * len(wanted[k]))
        assert r.item_words == len(wanted[k]) and r.distance == distance(wanted[k], w[r.start_word:r.start_word + len(wanted[k]) + most]) <= most


def test_edited_copies_reach_the_target_recall(spark, documents):
    rng, items = random.Random(9), spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    hosts = documents.where("length(text) > 300").limit(20).collect()
    rows, truth = [], set()
    for n in range(200):
        item, host = rng.choice(items), rng.choice(hosts).text.split(" ")
        own = item.text.split(" ")
        at = rng.randrange(len(host))
        rows.append((n, " ".join(host[:at] + edited(rng, own, max(1, len(own) // 15)) + host[at:]).encode().upper().decode()))
        truth.add((n, item.item_id))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, spark.createDataFrame(items)).collect()}
    assert len(got & truth) >= 0.9 * len(truth)


@pytest.mark.parametrize("n", [5, 6, 8, 10, 11, 12, 13, 14, 15, 16, 18, 20, 25, 30, 40, 60])
def test_decontamination_recall_at_all_edits_allowed(n):
    """Items of n words, each copied with the most edits that still make a copy."""
    draw = np.random.default_rng(n)
    word = lambda k: [f"w{j}" for j in draw.integers(0, 20_000, k)]
    items = [word(n) for _ in range(120)]
    texts = []
    for item in items:
        copy = list(item)
        for _ in range(int(decontaminate.MAX_EDIT_SHARE * n)):
            kind, at = draw.integers(3), int(draw.integers(len(copy)))
            copy[at:at + (kind != 1)] = [] if kind == 2 else [f"x{draw.integers(1 << 40)}"]
        texts.append(" ".join([*word(50), *copy, *word(50)]).encode())
    known = decontaminate.Items(list(range(120)), [" ".join(x).encode() for x in items])
    words = Words(texts, separator=decontaminate.SEPARATOR)
    found = decontaminate.with_enough_words(decontaminate.candidate_windows(words, known), words, known, decontaminate.MAX_EDIT_SHARE)
    best = decontaminate.verified(words, known, found, decontaminate.MAX_EDIT_SHARE)
    assert sum((k, k) in best for k in range(120)) >= 0.95 * 120


def test_a_long_item_is_found(spark):
    draw = np.random.default_rng(1)
    item = [f"w{j}" for j in draw.integers(0, 500, 10_000)]
    copy = [w if i % 50 else "edit" for i, w in enumerate(item)]
    docs = spark.createDataFrame([(1, " ".join(copy)), (2, " ".join(reversed(item)))], "doc_id bigint, text string")
    got = decontaminate.contaminated(docs, spark.createDataFrame([(7, " ".join(item))], "item_id bigint, text string")).collect()
    assert [(r.doc_id, r.item_id) for r in got] == [(1, 7)] and got[0].distance <= 200


def test_decontamination_of_awkward_tables(spark, awkward, nothing):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "word"), (4, "One id, TWO texts"), (4, "one id two texts"), (None, "a b c d")],
                                  "item_id int, text string")
    got = sorted((str(r.doc_id), str(r.item_id)) for r in decontaminate.contaminated(awkward, items).collect())
    assert got == sorted([("8", "3"), ("10", "None")] + [("7", "4")] * 4)
    assert decontaminate.contaminated(nothing, items).count() == 0
    assert decontaminate.contaminated(awkward, items.where("false")).count() == 0


@pytest.mark.parametrize("table", ["documents", "awkward", "nothing"])
def test_base_scores(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.select("doc_id", "text").collect()
    held = [zlib.crc32(("" if r.doc_id is None else str(r.doc_id)).encode()) % 7 == 2 for r in rows]
    counts: Counter = Counter()
    for r, h in zip(rows, held):
        if not h:
            counts.update([*words_of(r.text), None])
    n, v = sum(counts.values()), len(counts)
    expected = []
    for r, h in zip(rows, held):
        own = [*words_of(r.text), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        expected.append((str(r.doc_id), h, len(own), sum(counts[w] > 0 for w in own), n, round(base, 5)))
    got = lm_scoring.score(docs).collect()
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == sorted(expected)
    assert all(r.score <= 1e-9 for r in got)


def reference_score(own: list, counts: list[Counter], kept: list[set], hot: set, n: int, v: int, d: float) -> float:
    """Backoff by recursion over contexts, without states."""

    def prob(context: tuple, w) -> float:
        if not context:
            return (counts[1][w,] - d) / n if counts[1][w,] else d * v / n
        arcs = followers.get(context)
        if arcs is None:
            return prob(context[1:], w)
        if w in arcs:
            return (counts[len(context) + 1][*context, w] - d) / counts[len(context)][context]
        seen = sum((counts[len(context) + 1][*context, x] - d) / counts[len(context)][context] for x in arcs)
        below = sum(prob(context[1:], x) for x in arcs)
        return (1 - seen) / (1 - below) * prob(context[1:], w)

    followers: dict[tuple, set] = defaultdict(set)
    for grams in kept[2:]:
        for g in grams:
            followers[g[:-1]].add(g[-1])
    followers = dict(followers)
    return sum(math.log10(prob(tuple(own[max(0, i - 2):i]), w)) for i, w in enumerate(own))


def test_automaton_equals_backoff_by_recursion(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(30)], k=rng.randint(0, 60))) + (" one two three" if i % 3 else "") + f" rare{i % 97}"
             for i in range(240)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts: list[Counter] = [Counter() for _ in range(4)]
    for t in train:
        own = [*t.split(), None]
        for k in (1, 2, 3):
            counts[k].update(zip(*[own[j:] for j in range(k)]))
    n, v = sum(counts[1].values()), len(counts[1])
    n1, n2 = (sum(c == k for c in counts[1].values()) for k in (1, 2))
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2))) if n1 + n2 else 0.5
    least = max(2, math.ceil(lm_scoring.GRAM_SHARE * n))
    kept = [set(), *[{g for g, c in counts[k].items() if c >= least} for k in (1, 2, 3)]]
    got = {r.doc_id: r.score for r in lm_scoring.score(docs).collect()}
    for i, t in enumerate(texts):
        assert got[i] == pytest.approx(reference_score([*t.split(), None], counts, kept, set(), n, v, d), abs=1e-6)


def test_repeated_ngrams_count_however_large_the_corpus(spark):
    """N-grams that are there a few times, far below ``GRAM_SHARE`` of all tokens."""
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, [1 / (i + 1) for i in range(400)], k=80)) + f" seldom{i // 3} seen{i // 3} phrase{i // 3}" for i in range(4000)]
    train = [t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    counts: list[Counter] = [Counter() for _ in range(4)]
    for t in train:
        own = [*t.split(), None]
        for k in (1, 2, 3):
            counts[k].update(zip(*[own[j:] for j in range(k)]))
    n, v = sum(counts[1].values()), len(counts[1])
    assert lm_scoring.GRAM_SHARE * n > 4
    n1, n2 = (sum(c == k for c in counts[1].values()) for k in (1, 2))
    d = min(0.95, max(0.05, n1 / (n1 + 2 * n2)))
    kept = [set(), *[{g for g, c in counts[k].items() if c >= 2} for k in (1, 2, 3)]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.score for r in lm_scoring.score(docs).collect()}
    for i in range(0, 4000, 250):
        assert got[i] == pytest.approx(reference_score([*texts[i].split(), None], counts, kept, set(), n, v, d), abs=1e-6)


def test_model_beats_unigrams_on_held_out_text(spark):
    rows = lm_scoring.score(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_keys_and_counts_come_back_from_their_records():
    rng = np.random.default_rng(3)
    keys = np.unique(rng.integers(0, 2**64, 200_000, dtype=np.uint64))
    ends, got = lm_scoring.bounds(keys, 4), []
    for part, (a, b) in enumerate(zip(ends, ends[1:])):
        data = lm_scoring.pack(keys[a:b], lm_scoring.base_of(part, 4))
        assert len(data) <= 1 + 7 * (b - a)
        got.append(lm_scoring.unpack(data, lm_scoring.base_of(part, 4)))
    assert (np.concatenate(got) == keys).all() and not len(lm_scoring.unpack(lm_scoring.pack(keys[:0], 5), 5))
    for n in (np.array([0, 1, 254, 255, 256, 2**40]), np.zeros(0, np.int64)):
        assert (lm_scoring.unpack_counts(lm_scoring.pack_counts(n), len(n)) == n).all()
    one, index, place = lm_scoring.distinct(keys[rng.integers(0, 50, 400)])
    assert (one[place][index] == one).all() and (np.diff(one.astype(float)) > 0).all()


def test_only_ngrams_that_may_be_kept_are_asked_for():
    """A block asks for a trigram only if both its bigrams are kept, and texts come back from their records."""
    texts = [b"a b c", None, b"a b c", "\u00e4 \U0001f600 x".encode(), b""]
    rows = pa.table({"block": [3] * 5, "id": [1, None, 1, 2, 5], "held_out": [False] * 4 + [True], "text": [t if t is None else t.decode() for t in texts]})
    stored = lm_scoring._stored(rows)
    assert stored.num_rows == 1 and lm_scoring._texts(stored) == [t or b"" for t in texts] and lm_scoring._column(stored, "id").to_pylist() == [1, None, 1, 2, 5]
    asked = lm_scoring._ask([1, 2], 2)(stored)
    answers = [r for p, k in {(r["part"], r["k"]) for r in asked.to_pylist()}
               for r in lm_scoring._count(2)(pa.Table.from_pylist([r for r in asked.to_pylist() if (r["part"], r["k"]) == (p, k)], asked.schema)).to_pylist()]
    words = sum(np.frombuffer(r["answer"], "<i8") for r in answers if r["block"] < 0)
    assert words.tolist() == [13, 7, 3, 3]  # a, b, c twice, three words once, the end four times in training texts
    block = lm_scoring.Block(stored, 3, 2)
    block.answered([r for r in answers if r["block"] >= 0], 2)
    assert sorted(block.n[2].tolist()) == [0, 0, 0, 2, 2, 2] and block.asked(3).sum() == 2 and len(block.keys[3]) == 4


def test_languages(documents, awkward, nothing):
    rows = language_id.identify(documents).collect()
    assert len(rows) == documents.count()
    wrong = documents.withColumn("truth", F.col("lang")).withColumn("lang", F.when(F.col("doc_id") % 10 == 0, "en").otherwise(F.col("lang")))
    truth = {r.doc_id: r.truth for r in wrong.collect()}
    found = {r.doc_id: r.language for r in language_id.identify(wrong).collect()}
    assert np.mean([found[k] == v for k, v in truth.items()]) >= 0.97
    odd = language_id.identify(awkward).collect()
    assert len(odd) == awkward.count() and not any(r.accepted for r in odd if r.doc_id in (1, 2))
    assert language_id.identify(nothing).count() == 0
    none = language_id.identify(awkward.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.language for r in none} == {"und"} and not any(r.accepted for r in none)


def test_pairs_are_few_under_a_shared_passage(spark, monkeypatch):
    """Texts of 60 words of their own and one passage of 45: the pairs that are compared grow
    with the texts, not with their square; a few near copies among them are found."""
    compared = []
    plausible = jaccard_join.plausible
    monkeypatch.setattr(jaccard_join, "plausible", lambda pairs, classes: compared.append(pairs.count()) or plausible(pairs, classes))
    draw = np.random.default_rng(4)
    passage, n = " ".join(f"p{i}" for i in range(45)), 3000
    own = [[f"x{draw.integers(1 << 40)}" for _ in range(60)] for _ in range(n)]
    rows = [(i, " ".join(w[:30]) + " " + passage + " " + " ".join(w[30:])) for i, w in enumerate(own)]
    rows += [(n + i, " ".join(own[i][:30]) + " " + passage + " " + " ".join([*own[i][30:58], "new", "words"])) for i in range(5)]
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)).collect()}
    assert got == {i: i for i in range(n)} | {n + i: i for i in range(5)}
    assert sum(compared) < 60 * n


def brute_posteriors(rows: list[dict]) -> dict:
    """Language and posterior of each row, from the definition, one row after the other."""
    declared = Counter(r["lang"] for r in rows if r["lang"])
    languages = sorted(x for x, n in declared.items() if n >= language_id.MIN_ROWS)
    names, buckets = [*languages, "und"], language_id.BUCKETS
    seen = {x: Counter() for x in languages}
    grams = []
    for r in rows:
        code, _, _ = language_id._trigrams([(r["text"] or "").encode()])
        grams.append(code.tolist())
        if r["lang"] in seen:
            seen[r["lang"]].update(grams[-1])
    whole = {x: sum(seen[x].values()) for x in languages}

    def likelihood(x, g):
        return -math.log(buckets) if x == "und" else math.log((seen[x][g] + 0.5) / (whole[x] + 0.5 * buckets))

    means = [[sum(likelihood(x, g) for g in code) / max(1, len(code)) for x in names] for code in grams]
    of = [max(range(len(names)), key=lambda c: (m[c], -c)) for m in means]
    slot = [languages.index(r["lang"]) if r["lang"] in languages else len(languages) for r in rows]
    confusion = [[0.5] * len(names) for _ in names]
    hosts, suffixes, known = defaultdict(Counter), defaultdict(Counter), Counter()
    for r, code, c, d in zip(rows, grams, of, slot):
        if not code:
            continue
        known[c] += c < len(languages)
        if r["lang"]:
            confusion[c][d] += 1
        if r["host"]:
            hosts[r["host"], r["suffix"]][c] += 1
            if r["suffix"]:
                suffixes[r["suffix"]][c] += 1
    total = sum(known[c] for c in range(len(languages)))
    overall = [(known[c] + 1) / (total + len(languages)) * (1 - language_id.UND_PRIOR) for c in range(len(languages))] + [language_id.UND_PRIOR]
    weight, out = language_id.PRIOR_ROWS, {}
    for r, code, m, c, d in zip(rows, grams, means, of, slot):
        above, group = overall, hosts.get((r["host"], r["suffix"])) if r["host"] else None
        if group is not None and r["suffix"] in suffixes:
            n = suffixes[r["suffix"]]
            above = [(n[k] + p * weight) / (sum(n.values()) + weight) for k, p in enumerate(overall)]
        prior = above
        if group is not None:
            own = Counter(group)
            own[c] -= bool(code)
            prior = [(own[k] + p * weight) / (sum(own.values()) + weight) for k, p in enumerate(above)]
        logs = [min(len(code), language_id.EFFECTIVE_TRIGRAMS) * m[k] + math.log(max(prior[k], 1e-12)) for k in range(len(names))]
        if r["lang"]:
            logs = [x + math.log(confusion[k][d] / sum(confusion[k])) for k, x in enumerate(logs)]
        best = max(range(len(names)), key=lambda k: (logs[k], -k))
        out[r["id"]] = names[best], 1 / sum(math.exp(x - logs[best]) for x in logs)
    return out


def test_posteriors_equal_brute_force(spark):
    """All four kinds of evidence, with short texts, so that priors and declarations count."""
    rng = random.Random(11)
    letters = {"en": "abcdeft", "fr": "aeoulqn", "de": "enrstuw", "pt": "aoesmnr"}
    rows = []
    for i in range(600):
        x = rng.choice(list(letters))
        host = f"h{rng.randrange(4)}.{x}" if rng.random() < 0.7 else f"shared{rng.randrange(3)}.com" if rng.random() < 0.8 else None
        text = " ".join("".join(rng.choices(letters[x], k=rng.randint(1, 5))) for _ in range(rng.choice([0, 1, 2, 4, 30])))
        lang = x if rng.random() < 0.6 else rng.choice([None, "en", "klingon"])
        rows.append({"id": i, "text": text if i % 50 else None, "lang": lang, "host": host, "suffix": host.split(".")[1] if host else None})
    expected = brute_posteriors(rows)
    docs = spark.createDataFrame(rows, "id bigint, text string, lang string, host string, suffix string")
    docs = docs.withColumn("lang", F.when((F.col("lang") == "pt") & (F.col("id") % 2 == 0), "PT-br").otherwise(F.col("lang")))
    got = {r["id"]: r for r in language_id.identify(docs, id_col="id", host_col="host", suffix_col="suffix").collect()}
    assert len(got) == 600
    for i, (language, posterior) in expected.items():
        assert got[i].confidence == pytest.approx(posterior, rel=1e-3)
        assert got[i].language == language or posterior < 0.502


def test_rare_declared_languages_are_languages(spark):
    """40 languages of 0.2 % of the rows each, beside one of 92 %."""
    rng = random.Random(3)
    def words(i):
        own = random.Random(100 + i)
        return ["".join(own.choices("abcdefghijklmnopqrstuvwxyz", [own.random() ** 3 for _ in range(26)], k=own.randint(3, 8))) for _ in range(300)]
    codes = ["en", *[f"q{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(40)]]
    vocabulary = [words(i) for i in range(41)]
    of = [0] * 11_500 + [i for i in range(1, 41) for _ in range(25)]
    rows = [(n, " ".join(rng.choices(vocabulary[i], k=40)), codes[i], f"host{rng.randrange(50)}") for n, i in enumerate(of)]
    # a few rows of a rare language declare the common one, a few codes have next to no rows
    rows += [(50_000, " ".join(vocabulary[7][:60]), "en", "host1"), (50_001, " ".join(vocabulary[0][:60]), "zzz", "host1")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    assert language_id.declared_languages(docs.withColumnRenamed("lang", "declared")) == sorted(codes)
    got = {r.doc_id: r for r in language_id.identify(docs).collect()}
    right = [got[n].language == codes[i] and got[n].accepted for n, i in enumerate(of)]
    assert np.mean(right[:11_500]) >= 0.99 and np.mean(right[11_500:]) >= 0.97
    assert got[50_000].text_language == codes[7] and got[50_001].language == "en"


def test_page_languages_fuse_markup_suffix_and_host(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    evidence = language_id.page_evidence(pages)
    rows = language_id.identify(evidence, "page_id", host_col="host", suffix_col="suffix").collect()
    assert np.mean([r.language == r.declared for r in rows]) > 0.95
    # a page without usable text follows its host
    extra = spark.createDataFrame([(10_000 + i, f"https://solo.example.de/{i}", t) for i, t in enumerate(
        ["<html><body>" + "der die das und nicht ist eine verschied schung heit keit " * 5 + "</body></html>"] * 12 + ["<html></html>"])], pages.schema)
    trained = evidence.unionByName(language_id.page_evidence(extra))
    found = {r.page_id: r for r in language_id.identify(trained, "page_id", host_col="host", suffix_col="suffix").collect()}
    assert found[10_012].language == found[10_000].language and not found[10_012].accepted


def test_language_priors_are_smoothed_by_level(spark):
    rows = [("a", "x", 0, 5)] * 3 + [("b", "x", 1, 5)] + [("c", None, 1, 5)] + [(None, None, 0, 5)] * 2 + [("a", "x", 1, 0)]
    df = spark.createDataFrame(rows, "host string, suffix string, text_class int, n_trigrams bigint")
    hosts, overall = language_id._group_priors(df, 3)
    got = {(r.host, r.suffix): r for r in hosts.collect()}
    assert overall[:2] == pytest.approx([6 / 9 * 0.999, 3 / 9 * 0.999]) and list(got["a", "x"].host_counts) == [3, 0, 0]
    assert list(got["a", "x"].suffix_prior) == pytest.approx([(n + 8 * p) / 12 for n, p in zip((3, 1, 0), overall)])
    assert list(got["c", None].suffix_prior) == pytest.approx(overall)


def test_word_hashes_tell_words_apart():
    texts = ["", "a b  a\tA", "é É", "x" * 300_000 + " y", " lead", "tail\n", "\x0b\x0c\r"]
    words = Words([t.encode() for t in texts])
    assert words.counts().tolist() == [len(words_of(t)) for t in texts]
    flat = [w for t in texts for w in words_of(t)]
    assert len(set(words.hashes.tolist())) == len(set(flat)) and [words.word(i) for i in range(len(flat))] == flat
    many = Words([" ".join(map(str, range(200_000))).encode()])
    assert len(set(many.hashes.tolist())) == 200_000


def test_memo_is_bounded_and_right():
    memo = Memo(lambda x: x * 2, 10, {1: -1})
    assert [memo[i % 37] for i in range(500)] == [-1 if i % 37 == 1 else i % 37 * 2 for i in range(500)] and len(memo) <= 12
