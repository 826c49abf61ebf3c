from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from cohortry.llm import mixing, quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def expected_targets(sizes, weights=(1, 2, 3)):
    """Shares by weight, stopped at three times a source's words, reshared."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        left = total - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        if not open_:
            return fixed
        unit = left / sum(weight[s] for s in open_)
        above = [s for s in open_ if weight[s] * unit > 3 * sizes[s]]
        if not above:
            return fixed | {s: weight[s] * unit for s in open_}
        fixed |= {s: 3 * sizes[s] for s in above}


def source_rows():
    rows, key = [], 0
    for source, n, length in (("b", 400, 3), ("a", 40, 50), ("Z", 5, 2), (None, 60, 20), ("é", 30, 9)):
        for k in range(n):
            rows.append((key, "w " * (1 + (key * 37 + k) % length), "en", source))
            key += 1
    return rows + [(key, None, "en", "a"), (key + 1, " \n", "en", None), (key + 2, "", "en", "none")]


def test_mix_meets_the_targets(make_docs):
    rows = source_rows()
    docs = make_docs(rows).withColumnRenamed("n_chars", "size")
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets = expected_targets(dict(sizes))
    text_of = {r[0]: r[1] for r in rows}
    taken = Counter()
    for r in found:
        assert r["size"] == len(WORD.findall(text_of[r["doc_id"]] or ""))
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(targets[r["source"]], abs=1e-6)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(3, 0.002 * target)
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, again)) == sorted(map(key, found))


def test_rates_are_tilted(make_docs):
    """Of one source, rates are a function of the size, and rise or fall with it."""
    rows = [(k, "w " * (1 + k % 30), "en", "a") for k in range(600)]
    rows += [(1000 + k, "w " * 30, "en", "b") for k in range(10)]
    found = mixing.mix(make_docs(rows)).collect()
    by_size = {}
    for r in found:
        if r["source"] == "a":
            by_size.setdefault(r["size"], []).append(r["copies"])
    low = [sum(by_size[s]) / len(by_size[s]) for s in range(1, 11)]
    high = [sum(by_size[s]) / len(by_size[s]) for s in range(21, 31)]
    target = next(r["target"] for r in found if r["source"] == "a")
    whole = sum(r["size"] for r in found if r["source"] == "a")
    assert (sum(high) > sum(low)) == (target > whole)


def test_mixed_documents_are_repeated_rows(make_docs):
    rows = source_rows()
    docs = make_docs(rows)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    times = Counter(r["doc_id"] for r in mixed.collect())
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(docs).collect() if r["copies"]}
    assert dict(times) == copies


def test_mix_of_little(make_docs):
    empty = make_docs([(1, "a")]).where("doc_id < 0")
    assert mixing.mix(empty).collect() == []
    assert mixing.mixed_documents(empty).collect() == []
    blank = mixing.mix(make_docs([(1, None), (2, "")])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in blank] == [(0, 0, 0.0)] * 2
    one = mixing.mix(make_docs([(1, "a b c", "en", "s"), (1, "a b c", "en", "s")])).collect()
    assert [r["taken"] for r in one] == [3, 3]


def test_repeated_rows_share_the_extra_copies(make_docs):
    """Rows of one doc_id and size, or of no doc_id: some get a copy more, so that no words are missing."""
    rows = [(7, "w " * 5, "en", "a")] * 800 + [(None, "w " * 4, "en", "b")] * 900
    rows += [(100 + k, "w " * (1 + k % 9), "en", "c") for k in range(500)]
    docs = make_docs(rows)
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    taken, targets, copies = Counter(), {}, Counter()
    for r in found:
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
        copies[r["source"], 2 * r["size"]] += r["copies"]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 5
    mixed = mixing.mixed_documents(docs).collect()
    assert Counter((r["source"], len(r["text"])) for r in mixed) == +copies


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "base_failed": n < 50 or 100 * len(covered) > 50 * n,
    }


TEXTS = [
    None, "", " \n\t", "a b c", "a b c a b c", "a a a a", "x y z w x y z", "one\n\none\n one\none \n", "👍 é ﬁ **",
    "a\x0bb\x0cc\x1cd\xa0e", "r s t " * 40, "\n".join(["same line here"] * 30), "w " * 49, "w%d " * 60,
    " ".join(f"w{k}" for k in range(200)), "it is a fine day, and | so | on <b> & #1 $2 100%\n" * 3,
    "big " + "lorem ipsum dolor " * 15_000,
]


def test_counts(make_docs):
    rows = list(enumerate(TEXTS))
    found = quality.features(make_docs(rows).withColumnRenamed("lang", "n_words")).collect()
    for r in found:
        expected = counts(TEXTS[r["doc_id"]])
        assert {k: r[k] for k in expected} == expected, r["doc_id"]


def reference_posterior(votes, share, good, bad):
    odds = math.log(share / (1 - share))
    for vote, g, b in zip(votes, good, bad):
        odds += {1: math.log(g / (1 - b)), -1: math.log((1 - g) / b), 0: 0.0}[vote]
    return 1 / (1 + math.exp(-odds))


def reference_fit(votes):
    """The same iteration in plain Python."""
    share, n = quality.PRIOR_SHARE, len(quality.RULES)
    good, bad = [quality.GOOD_PASSES] * n, [quality.BAD_FAILS] * n

    def rate(hits, total, prior, bounds):
        value = (hits + prior * quality.PRIOR_VOTES) / (total + quality.PRIOR_VOTES)
        return min(max(value, bounds[0]), bounds[1])

    for _ in range(quality.STEPS):
        p = [reference_posterior(v, share, good, bad) for v in votes]
        old = (share, *good, *bad)
        share = rate(sum(p), len(votes), quality.PRIOR_SHARE, (0.05, 0.95))
        good = [
            rate(sum(q for q, v in zip(p, votes) if v[k] == 1), sum(q for q, v in zip(p, votes) if v[k]),
                 quality.GOOD_PASSES, quality.GOOD_RANGE) for k in range(n)
        ]
        bad = [
            rate(sum(1 - q for q, v in zip(p, votes) if v[k] == -1),
                 sum(1 - q for q, v in zip(p, votes) if v[k]), quality.BAD_FAILS, quality.BAD_RANGE)
            for k in range(n)
        ]
        if max(abs(a - b) for a, b in zip(old, (share, *good, *bad))) < 1e-6:
            break
    return share, good, bad


def test_posterior_is_that_of_the_reference(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = quality.quality_rules(docs).collect()
    assert len(found) == docs.count()
    votes = [[r[f"vote_{name}"] for name in quality.RULES] for r in found]
    share, good, bad = reference_fit(votes)
    for r, v in zip(found, votes):
        p = reference_posterior(v, share, good, bad)
        assert r["quality"] == pytest.approx(p, abs=1e-6)
        assert r["kept"] == (not r["base_failed"] and r["quality"] >= 0.5)


def test_junk_goes_and_clean_text_stays(spark, small):
    found = quality.quality_rules(spark.read.parquet(f"{small}/documents.parquet"))
    judged = found.drop("quality").join(spark.read.parquet(f"{small}/labels.parquet"), "doc_id").where("NOT base_failed")
    right = judged.where("kept = (quality = 1)").count()
    assert right >= 0.95 * judged.count()


def test_nothing_runs_python(make_docs):
    plan = quality.quality_rules(make_docs(list(enumerate(TEXTS))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_kept_documents_keep_their_columns(make_docs):
    docs = make_docs(list(enumerate(TEXTS)))
    kept = quality.kept_documents(docs)
    verdict = {r["doc_id"]: r["kept"] for r in quality.quality_rules(docs).collect()}
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(k for k, v in verdict.items() if v)
    assert quality.kept_documents(docs.where("doc_id < 0")).collect() == []
