"""Stages of the pipeline against plain Python, on rows that are awkward or clash."""

import itertools
import re

import pytest

import corpus_pipeline
from gantrylake.llm.queries import tokenizer_path

STAGES = dict(corpus_pipeline.STAGES)
SPACES = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    words = SPACES.findall((text or "").lower())
    return {tuple(words[n : n + width]) for n in range(max(1, len(words) - width + 1))} if words else set()


def plain_keepers(rows):
    """(id, text) of one row of each group of near duplicates, by all pairs."""
    rows = sorted(set(rows), key=lambda row: (row[0] is None, row[0] or 0, row[1] is not None, row[1] or ""))
    sets = [shingles(text) for _, text in rows]
    group = list(range(len(rows)))
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
            old, new = max(group[a], group[b]), min(group[a], group[b])
            group = [new if one == old else one for one in group]
    return [{rows[n] for n in range(len(rows)) if group[n] == one} for one in sorted(set(group))]


def test_one_row_of_each_group_whatever_the_ids(spark):
    base = " ".join(f"w{n}" for n in range(60))
    near = base.replace("w30", "other")
    rows = [(5, base), (5, near), (7, base), (None, base), (None, near), (None, "nobody else has this text at all"), (None, None), (None, "")]
    rows += [(9, "short"), (9, "SHORT"), (9, "short"), (3, " ".join(f"x{n}" for n in range(40))), (8, None), (8, None), (2, "a b c d e f g")]
    docs = spark.createDataFrame([(*row, "en", n) for n, row in enumerate(rows)], "doc_id long, text string, lang string, row int")
    kept = STAGES["n-gram Jaccard join"](spark, docs, "")
    assert kept.columns == docs.columns
    found = [(r.doc_id, r.text) for r in kept.collect()]
    groups = plain_keepers(rows)
    assert len(found) == len(groups)
    for group in groups:
        (one,) = [row for row in found if row in group]
        least = min((row for row in group if row[0] is not None), default=None, key=lambda row: row[0])
        assert least is None or one[0] == least[0]


def test_joins_of_the_table_by_all_pairs(spark, documents):
    docs = documents.where("doc_id < 120")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = {min(row[0] for row in group) for group in plain_keepers(rows)}
    assert {r.doc_id for r in STAGES["n-gram Jaccard join"](spark, docs, "").collect()} == want


def test_quality_keeps_clean_documents(spark, documents, sf_dir):
    graded = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    kept = {r.doc_id for r in STAGES["quality classifier"](spark, documents, sf_dir).collect()}
    good = {n for n, quality in graded.items() if quality == 1}
    assert len(good & kept) >= 0.97 * len(good)
    assert not {n for n, quality in graded.items() if quality == 0} & kept


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_documents_with_a_window_go_and_no_others(spark, documents, sf_dir):
    windows = set()
    for row in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect():
        words = words_of(row.text)
        size = min(10, len(words))
        windows |= {tuple(words[n : n + size]) for n in range(len(words) - size + 1)} if size else set()
    sizes = {len(window) for window in windows}

    def hit(text):
        words = words_of(text)
        return any(tuple(words[n : n + size]) in windows for size in sizes for n in range(len(words) - size + 1))

    want = {r.doc_id for r in documents.collect() if not hit(r.text)}
    assert 0 < len(want) < documents.count()
    assert {r.doc_id for r in STAGES["benchmark decontamination"](spark, documents, sf_dir).collect()} == want


def test_packing_gives_back_every_text(spark, documents, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_path())
    docs = documents.where("doc_id < 60")
    pieces = {}
    for r in STAGES["packing"](spark, docs, sf_dir).collect():
        ids = [int.from_bytes(r.ids[n : n + 4], "little") for n in range(0, len(r.ids), 4)]
        assert len(ids) == r.length <= 2048
        pieces.setdefault(r.doc_id, []).append((r.start, ids))
    for row in docs.collect():
        joined = [one for _, ids in sorted(pieces[row.doc_id]) for one in ids]
        assert joined == [*library.encode(row.text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_columns_of_any_name_pass_through(spark, sf_dir, name):
    clash = ["row", "spans", "items", "kept", "component_id", "n_words", "node", "label", "short", "_key2", "with.dot"]
    rows = [(n, f"text number {n} with some words", "en", "s", 30, *[n] * len(clash)) for n in range(4)] + [(None, None, None, None, None, *[None] * len(clash))]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{one}` int" for one in clash)
    docs = spark.createDataFrame(rows, kinds)
    done = STAGES[name](spark, docs, sf_dir)
    assert done.columns == docs.columns
    assert done.count() <= 5
