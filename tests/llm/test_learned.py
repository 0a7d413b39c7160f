"""Learned operators: gradients, samples, and held-out figures of the registered queries."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from gantrylake.llm import language
from gantrylake.llm.queries import REGISTRY, remainder
from gantrylake.llm.sampling import collected, labelled_sample, sample_of
from gantrylake.llm.scratch import Scratch

SIZES = [1, 4, 0, 3, 5]


def chains(seed, labels=3):
    random = np.random.default_rng(seed)
    return random.normal(0, 2, (sum(SIZES), labels)), np.concatenate([[0], np.cumsum(SIZES)]), random.normal(0, 1.5, (labels, labels))


def paths(scores, transitions):
    """Every path of one sequence with its weight; an empty sequence has none."""
    if not len(scores):
        return
    for path in itertools.product(range(scores.shape[1]), repeat=len(scores)):
        total = sum(scores[n, label] for n, label in enumerate(path)) + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False))
        yield path, np.exp(total) * np.exp(transitions)[:, path[0]].sum()  # the label before the first word is unknown


@pytest.mark.parametrize("seed", range(10))
def test_chances_and_pairs_over_all_paths(seed):
    scores, first, transitions = chains(seed)
    chance, later, pairs = language.pair_chances(scores, first, transitions)
    want, want_pairs = np.zeros_like(chance), np.zeros((len(scores), 3, 3))
    for a, b in zip(first, first[1:], strict=False):
        total = sum(weight for _, weight in paths(scores[a:b], transitions))
        for path, weight in paths(scores[a:b], transitions):
            for n, label in enumerate(path):
                want[a + n, label] += weight / total
                if n:
                    want_pairs[a + n, path[n - 1], label] += weight / total
    assert np.allclose(chance, want) and np.allclose(language.forward_backward(scores, first, transitions), want)
    assert np.allclose(pairs, want_pairs[later])
    assert later.tolist() == [n for a, b in zip(first, first[1:], strict=False) for n in range(a + 1, b)]


def test_transition_gradient_by_finite_differences():
    scores, first, transitions = chains(5)
    right = np.random.default_rng(1).integers(0, 3, len(scores))

    def loss(moved):
        out = 0.0
        for a, b in zip(first, first[1:], strict=False):
            if a < b:
                own = sum(scores[n, right[n]] for n in range(a, b)) + sum(moved[right[n - 1], right[n]] for n in range(a + 1, b))
                own += np.log(np.exp(moved)[:, right[a]].sum())
                out += np.log(sum(weight for _, weight in paths(scores[a:b], moved))) - own
        return out

    chance, _, pairs = language.pair_chances(scores, first, transitions)
    slope = language.transition_slope(chance, pairs, right, first, transitions)
    for a, b in itertools.product(range(3), repeat=2):
        step = np.zeros((3, 3))
        step[a, b] = 1e-5
        assert abs((loss(transitions + step) - loss(transitions - step)) / 2e-5 - slope[a, b]) < 1e-5


def test_long_chains_keep_their_pairs():
    random = np.random.default_rng(2)
    scores, transitions = random.normal(0, 1, (200, 2)), random.normal(0, 1, (2, 2))
    _, later, pairs = language.pair_chances(scores, np.array([0, 200]), transitions)
    chance = language.forward_backward(scores, np.array([0, 200]), transitions)
    assert np.allclose(pairs.sum(2), chance[later - 1]) and np.allclose(pairs.sum(1), chance[later])


# --- samples -------------------------------------------------------------------------------


def sample(rows, limit, **options):
    scratch = Scratch(rows.sparkSession, "sample-test")
    found = collected(sample_of(rows, limit, scratch, **options))
    scratch.drop()
    return found


def test_samples_are_bounded_and_even(spark):
    rows = spark.range(6000).select(
        F.when(F.col("id") < 20, "rare").when(F.col("id") < 2000, "some").otherwise("most").alias("lang"),
        F.when(F.col("id") % 3 == 0, F.lit("the same text")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"),
    )
    found = sample(rows, 90, group="lang")
    by_lang = {lang: [r for r in found if r["lang"] == lang] for lang in ("rare", "some", "most")}
    assert len(by_lang["rare"]) == 14 and len(by_lang["some"]) == len(by_lang["most"]) == 30
    assert len({(r["lang"], r["text"]) for r in found}) == len(found)
    assert found == sample(rows.repartition(5), 90, group="lang")
    assert sum(len(r["text"]) for r in sample(rows, 90, group="lang", most=100)) <= 100
    assert sample(rows.limit(0), 90, group="lang") == []


def test_one_id_with_most_rows_stays_bounded(spark):
    docs = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("id"), F.concat(F.lit("t"), F.col("id") % 2000).alias("text"))
    labels = spark.createDataFrame([(1, 1.0), (1, 0.0), (3500, 1.0), (None, 1.0), (3600, None)], "id long, label double")
    scratch = Scratch(spark, "sample-test")
    found = collected(labelled_sample(docs, labels, 50, scratch))
    assert len(found) == 50 and {r["label"] for r in found} == {0.0, 1.0}
    assert collected(labelled_sample(docs, labels.limit(0), 50, scratch)) == []


# --- registered queries on rows that were not learned from ---------------------------------------

LEARNED = "/root/testdata/sf0.1"


def test_held_out_languages(spark):
    docs = spark.read.parquet(f"{LEARNED}/documents.parquet").select("doc_id", "lang")
    found = REGISTRY["op3_word_languages"](spark, LEARNED).join(docs, "doc_id")
    held = found.where("held_out AND lang IS NOT NULL")
    right = held.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert found.count() == docs.count() and held.count() > 200 and right > 0.93


def test_held_out_toxicity(spark):
    labels = spark.read.parquet(f"{LEARNED}/labels.parquet").select("doc_id", "toxic")
    found = REGISTRY["op4_toxicity"](spark, LEARNED)
    held = found.where("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in held if r.toxic]
    clean = [r for r in held if r.toxic == 0]
    assert found.where((F.col("score") < 0) | (F.col("score") > 1)).count() == 0
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)
    assert not toxic or sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    # Far from 0 and 1 the order of scores still tells: a toxic row lies above a clean one.
    above = [t.score > c.score for t in toxic for c in clean]
    assert not above or sum(above) >= 0.9 * len(above)


def test_held_out_quality(spark):
    from gantrylake.llm.quality import fit_quality, grade_quality

    docs = spark.read.parquet(f"{LEARNED}/documents.parquet")
    labels = spark.read.parquet(f"{LEARNED}/labels.parquet").where("quality IS NOT NULL")
    model = fit_quality(docs, labels.where(remainder(4) != 0))
    held = grade_quality(docs, model).join(labels.where(remainder(4) == 0), "doc_id").collect()
    assert len(held) > 50
    assert sum(r.accepted == bool(r.quality) for r in held) >= 0.9 * len(held)
    assert REGISTRY["op1_quality_grades"](spark, LEARNED).count() == docs.count()
