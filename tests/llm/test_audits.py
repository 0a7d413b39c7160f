"""Filter audit, Merkle manifest and personal data against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import pytest

from gantrylake.llm import personal
from gantrylake.llm.filter_audit import audit_filters, audit_orders, failure_counts
from gantrylake.llm.manifest import merkle_manifest
from gantrylake.llm.queries import REGISTRY

SPACES = re.compile(r"[^\x20\x09-\x0D]+")


# --- filter audit --------------------------------------------------------------------------


def plain_failures(rows):
    least = {}
    for doc_id, _, text in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    for doc_id, lang, text in rows:
        text = text or ""
        words = SPACES.findall(text)
        failed = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and least[text] < doc_id,
        }
        yield doc_id, lang or "", failed


def plain_audit(rows, good, toxic):
    docs = list(plain_failures(rows))
    out = {}
    for part in {lang for _, lang, _ in docs}:
        mine = [(doc_id, failed) for doc_id, lang, failed in docs if lang == part]
        removed = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = mine
            for step, letter in enumerate(order, 1):
                here = [d for d in left if d[1][letter]]
                left = [d for d in left if not d[1][letter]]
                all_failing = sum(failed[letter] for _, failed in mine)
                only = sum(failed[letter] and sum(failed.values()) == 1 for _, failed in mine)
                removed[letter] += len(here)
                out[part, order, step] = [
                    len(left), len(here), all_failing - len(here), only, sum(d in good for d, _ in here), sum(d in toxic for d, _ in here),
                ]
        for (p, order, step), figures in out.items():
            if p == part:
                figures.append(removed[order[step - 1]])
    return out


def audited(table):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in table.collect()}


def test_audit_equals_plain_python(spark):
    long = " ".join(f"word{n}" for n in range(250))
    rows = [(1, "en", long), (2, "en", long), (2, "en", long), (3, None, long), (4, "", None), (5, "en", ""), (6, "de", "same " * 300)]
    rows += [(7, "de", long + " #"), (8, "de", long.upper()), (None, "en", long), (None, None, None), (9, "de", "a|b " * 150), (3, "fr", long + " #")]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string").selectExpr("*", "1 AS part", "text AS digest")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (2, 0, None), (6, None, 1), (7, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    want = plain_audit(rows, {1, 2, 7}, {2, 6, 7})
    assert audited(audit_filters(docs, labels)) == want
    assert audited(audit_filters(docs.limit(0), labels)) == {}
    assert audited(audit_filters(docs, labels.limit(0))) == plain_audit(rows, set(), set())


def test_hot_text_and_hot_id_are_a_few_cells(spark):
    docs = spark.range(3000).selectExpr("IF(id < 1000, 7, id) AS doc_id", "'en' AS lang", "IF(id % 3 = 0, 'copy', CAST(id AS STRING)) AS text")
    labels = spark.createDataFrame([(7, 1, 0)], "doc_id long, quality int, toxic int")
    cells = failure_counts(docs, labels).collect()
    assert sum(c.n for c in cells) == 3000
    assert sum(c.n for c in cells if c["mask"] & 16) == 667 - 1  # copies under ids above 7 (1000 + ids); one id shares the least
    assert sum(c.n for c in cells if c.good) == 1000


def test_audit_takes_any_few_filters(spark):
    counts = spark.createDataFrame([("x", 0, False, False, 3), ("x", 1, True, False, 2), ("x", 3, False, True, 1)], "part string, mask int, good boolean, toxic boolean, n long")
    rows = {(r.filter_order, r.step): r for r in audit_orders(counts, "PQ").collect()}
    assert (rows["PQ", 1].removed, rows["PQ", 2].removed, rows["QP", 1].removed, rows["QP", 2].removed) == (3, 0, 1, 2)
    assert rows["PQ", 1].shapley == 5 and rows["PQ", 2].redundant == 1
    with pytest.raises(ValueError):
        audit_orders(counts, "ABCDEFGH")


# --- manifest ------------------------------------------------------------------------------


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves):
    """(root, siblings of each leaf, path folds) of one list of digests."""
    siblings = [[] for _ in leaves]
    level, members = list(leaves), [[n] for n in range(len(leaves))]
    while len(level) > 1:
        up, owners = [], []
        for at in range(0, len(level), 3):
            run = level[at : at + 3]
            for place in range(len(run)):
                for leaf in members[at + place]:
                    siblings[leaf].append((run[:place], run[place + 1 :]))
            up.append(sha(*run))
            owners.append([leaf for one in members[at : at + 3] for leaf in one])
        level, members = up, owners
    return level[0], siblings


def plain_manifest(rows):
    def leaf(row, text):
        return sha(*[framed(row[name]) for name in ("doc_id", "source", "lang", "n_chars")], framed(text))

    sources = defaultdict(list)
    for row in rows:
        sources[row["source"]].append(row)
    names = sorted(sources, key=lambda name: (name is not None, (name or "").encode()))
    trees, out = [], []
    for name in names:
        own = sorted(sources[name], key=lambda row: (row["doc_id"] is not None, row["doc_id"] or 0, leaf(row, row["text"])))
        trees.append((own, *plain_tree([leaf(row, row["text"]) for row in own])))
    root, tops = plain_tree([tree[1] for tree in trees])
    for (own, subroot, below), above in zip(trees, tops, strict=True):
        for row, path in zip(own, below, strict=True):
            text, doc_id = row["text"], row["doc_id"]
            if text is not None and doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded = leaf(row, text)
            for left, right in path + above:
                folded = sha(*left, folded, *right)
            proof = sha(*[d for left, right in path + above for d in left + right])
            out.append((doc_id, leaf(row, row["text"]), subroot, root, proof, folded, folded == root))
    return out


MANIFEST = "doc_id long, source string, lang string, n_chars long, text string, row string, tree int"


def same_rows(got, want):
    key = lambda row: tuple((v is not None, v) for v in row)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


@pytest.mark.parametrize("sizes", [[1], [1, 1], [2], [3, 4, 1, 9, 10, 28, 82]])
def test_manifest_equals_plain_python(spark, sizes):
    rows, number = [], 0
    for n, size in enumerate(sizes):
        for _ in range(size):
            number += 7
            source = None if n == 2 else ["b", "a", "", "é", "Z", "zz", "a b"][n]
            rows.append((number % 101, source, None if number % 3 else "en", number, None if number % 11 == 0 else f"line\nnumber {number}\n", "x", 1))
    rows += [(None, "a", None, None, None, None, None), (None, "a", None, None, "é\n", None, None)] * (len(sizes) > 2)
    docs = spark.createDataFrame(rows, MANIFEST)
    want = plain_manifest([dict(zip(docs.columns, row, strict=True)) for row in rows])
    got = merkle_manifest(docs).collect()
    same_rows(got, want)
    assert len(sizes) < 3 or {r.verified for r in got} == {True, False}


def test_manifest_over_one_large_source(spark):
    rows = [(n, "big" if n % 3 else "s" + str(n % 7), "en", n, f"text {n}\n" * (n % 3)) for n in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").repartition(7)
    same_rows(merkle_manifest(docs).collect(), plain_manifest([dict(zip(docs.columns, row, strict=True)) for row in rows]))


def test_manifest_of_repeated_rows_and_of_nothing(spark):
    docs = spark.createDataFrame([(1, "a", "en", 2, "x\n", "", 1)] * 7, MANIFEST)
    want = plain_manifest([dict(zip(docs.columns, row, strict=True)) for row in docs.collect()])
    same_rows(merkle_manifest(docs).collect(), want)
    assert merkle_manifest(docs.limit(0)).collect() == []


def test_row_limit_of_recursive_queries_is_put_back(spark):
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, "5")
    try:
        docs = spark.createDataFrame([(n, "a", "en", n, "x") for n in range(20)], "doc_id long, source string, lang string, n_chars long, text string")
        assert merkle_manifest(docs).count() == 20
        assert spark.conf.get(name) == "5"
    finally:
        spark.conf.set(name, before)


# --- personal data -------------------------------------------------------------------------

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(number):
    places = [int(c) for c in reversed(number)]
    return sum(x if n % 2 == 0 else 2 * x - 9 * (x > 4) for n, x in enumerate(places)) % 10 == 0


def counts(kind, hit):
    number = re.sub("[^0-9]", "", hit)
    if kind == "ip":
        return all(int(part) <= 255 for part in hit.split("."))
    if kind == "card":
        return 16 <= len(number) <= 19 and plain_luhn(number)
    return kind == "email" or 8 <= len(number) <= 15


def plain_base(text):
    hits = [(kind, m.start(), m.end()) for kind, form in FORMS.items() for m in re.finditer(form, text or "")]
    return [f"{kind}:{a}:{b}" for kind, a, b in hits if counts(kind, text[a:b])]


AWKWARD_TEXTS = [
    None, "", "a@b.c", "a@b", "x.y+z@a-b.co.uk.", "a@b.c_d@e.f", "a@b.c.@d.e", "é1@x.yé", "@a.b", "a@@b.c", "ab@c.d@e.f",
    "1.2.3.4.5.6.7.8.9", "256.1.1.1 1.1.1.1", "0001.02.3.255", "1.2.3.4", "999999999999.1.1.1",
    "4111111111111111", "4111 1111-1111 1111", "4111  1111 1111 1111", "41111111111111112", "5500005555555559 4111111111111111",
    "+1 (136) 555-7479", "+1 136", "+12345678901234567", "+1+1 2345 6789", "++1.2.3.4.5.6.7.8", "+1 (((((((", "+1-----9",
    "中文 4111111111111111 \U0001f600 a@b.c\n+1 (136) 555-7479", "1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7 8 9",
]


def found_spans(table):
    return {row["doc_id"]: row["spans"] for row in table.select("doc_id", personal.shown(personal.F.col("spans")).alias("spans")).collect()}


def test_base_spans_equal_plain_forms(spark):
    docs = spark.createDataFrame(list(enumerate(AWKWARD_TEXTS)), "doc_id long, text string").selectExpr("*", "1 AS base", "'x' AS at")
    table = personal.find_personal(docs)
    got = {r[0]: r[1] for r in table.select("doc_id", personal.shown(personal.F.col("base"))).collect()}
    assert got == {n: ",".join(plain_base(text)) for n, text in enumerate(AWKWARD_TEXTS)}
    assert personal.find_personal(docs.limit(0)).collect() == []


def test_base_spans_over_the_whole_table(spark, sf_dir, texts):
    rows = REGISTRY["op13_personal_data"](spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        base = plain_base(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(one.startswith(kind) for one in base) for kind in FORMS]
        assert set(base) <= set(row.spans.split(",")) | {""}


def test_long_runs_and_long_texts_take_linear_time(spark):
    many = " ".join(f"u{n}@host{n}.example.com +1 (136) 555-{n:04d}" for n in range(3000))
    long = ["a" * 200_000, "1" * 200_000, "a.b" * 60_000 + "@" + "x." * 60_000, "1." * 100_000, "+1" + "(" * 200_000, "9 " * 100_000, many]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string")
    rows = {r.doc_id: r for r in personal.find_personal(docs).select("doc_id", *[personal.count_of(k).alias(k) for k in personal.KINDS]).collect()}
    assert (rows[6].email, rows[6].phone) == (3000, 3000)
    assert rows[2].email == 1 and rows[3].ip == 25_000 and rows[0].email == rows[4].phone == 0


def plain_bootstrap(texts, rule):
    """The learned part, by dictionaries: spans added to each text's base spans."""
    token = re.compile(r"(?<![A-Za-z0-9_%+.@()-])[A-Za-z_%+.()-]*[0-9@][A-Za-z0-9_%+.@()-]*(?: [(]?[0-9][0-9().-]*)*")
    name = lambda surface: re.sub("[^A-Za-z0-9@]+", "", surface).lower()
    loose = {kind: re.compile(form) for kind, form in personal.LOOSE.items()}
    known, seen, edges = {}, [], defaultdict(set)
    for n, text in enumerate(texts):
        for span in plain_base(text):
            kind, a, b = span.split(":")
            own = name(text[int(a) : int(b)])
            known[own] = min(known.get(own, 9), personal.KINDS.index(kind))
    for n, text in enumerate(texts):
        last = 0
        for m in token.finditer(text or ""):
            before = re.sub(r"\s+", " ", text[last : m.start()][-48:].lower())
            last = m.end()
            core = m.group().lstrip(".)_%-")
            start = m.end() - len(core)
            core = core.rstrip(".()_%+-")
            found = [re.search(rf"(?:[^\W\d_]+(?:[\W\d_]){{1,6}}){{{k}}}$", before) for k in (1, 2)]
            contexts = [hit.group() for hit in found if hit]
            digits = re.sub("[^0-9]", "", core)
            allowed = {k for k, kind in enumerate(personal.KINDS) if loose[kind].search(core)}
            allowed -= {2} if not (digits and plain_luhn(digits)) else set()
            allowed -= {3} if not 7 <= len(digits) <= 15 else set()
            seen.append((n, start, start + len(core), name(core), contexts, allowed))
            if name(core):
                for context in contexts:
                    edges[context, name(core)] |= allowed
    added = {}
    for _ in range(rule.rounds):
        behind = defaultdict(list)
        for context, own in edges:
            behind[context].append(own)
        score = {}
        for context, owns in behind.items():
            for kind in range(4):
                hits = sum(known.get(own) == kind for own in owns)
                if hits:
                    score[context, kind] = (hits, hits / len(owns))
        firm = {key for key, (hits, share) in score.items() if hits >= rule.support and share >= rule.precision}
        votes, degree = defaultdict(list), Counter()
        for (context, own), allowed in edges.items():
            if own not in known and allowed:
                degree[own] += 1
                for kind in allowed:
                    if (context, kind) in score:
                        votes[own, kind].append((score[context, kind][1], (context, kind) in firm))
        best = {}
        for (own, kind), given in votes.items():
            mean = sum(share for share, _ in given) / degree[own]
            if any(sure for _, sure in given) and mean >= rule.mean:
                best[own] = max(best.get(own, (-1, -9)), (mean, -kind))
        if not best:
            break
        added |= {own: -kind for own, (_, kind) in best.items()}
        known |= {own: -kind for own, (_, kind) in best.items()}
        trusted = firm
    out = [plain_base(text) for text in texts]
    for n, start, end, own, contexts, _ in seen:
        kind = added.get(own)
        if kind is not None and any((context, kind) in trusted for context in contexts):
            if not any(int(a) < end and start < int(b) for a, b in (span.split(":")[1:] for span in plain_base(texts[n]))):
                out[n].append(f"{personal.KINDS[kind]}:{start}:{end}")
    order = lambda span: (personal.KINDS.index(span.split(":")[0]), int(span.split(":")[1]))
    return [",".join(sorted(spans, key=order)) for spans in out]


def planted_texts():
    texts = [f"Question {n}. Please call me at +1 (136) 555-74{n:02d} before noon, é." for n in range(60)]
    texts += ["é Please call me at (136) 555-9999, or later.", "Dinner at 8, room 5551234 is free."]
    texts += [f"the backup host 10.0.0.{n} failed" for n in range(9)] + ["then the backup host 10-0-0-77 failed; host 12 too"]
    texts += [f"Write to: user{n}@example.com now" for n in range(12)] + ["Write to: root@localhost now", "Write to: 12 people"]
    # Found in a second round only: its context is trusted once identifiers of the first round are known.
    texts += [f"Call me at (136) 555-98{n:02d}. Line (136) 555-98{n:02d} is shut" for n in range(8)] + ["Line 555-1234567 is shut"]
    return texts + [None, "", "Please call me at +1 (136) 555-7400 or (136) 555-9999"]


def test_contexts_discover_unseen_identifiers(spark):
    texts, rule = planted_texts(), personal.Bootstrap()
    want = plain_bootstrap(texts, rule)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = found_spans(personal.find_personal(docs))
    assert [got[n] for n in range(len(texts))] == want
    assert texts[60][20:34] == "(136) 555-9999" and got[60] == "phone:20:34"
    assert got[61] == "" and got[71] == "ip:21:30" and got[84] == "email:10:24" and got[85] == ""
    assert got[94] == "phone:5:16"


def test_added_seeds_name_identifiers_that_no_form_has(spark):
    texts = [f"badge holder 77-{n:04d}-5 entered" for n in range(1000, 1008)] + ["badge holder 77-9999-5 entered"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    seeds = spark.createDataFrame([("phone", f"77-{n:04d}-5") for n in range(1000, 1008)] + [("other", "1")], "kind string, surface string")
    assert set(found_spans(personal.find_personal(docs)).values()) == {""}
    got = found_spans(personal.find_personal(docs, seeds=seeds))
    assert got[8] == "phone:13:22"


def test_no_python_in_the_plan(spark, sf_dir):
    plan = REGISTRY["op13_personal_data"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_awkward_rows(spark, awkward, nothing, labels):
    assert personal.find_personal(awkward, carry=awkward.columns).columns == [*awkward.columns, "base", "spans"]
    assert personal.find_personal(awkward).count() == merkle_manifest(awkward).count() == awkward.count()
    assert {r.part for r in audit_filters(awkward, labels).select("part").distinct().collect()} == {"", "en"}
    assert merkle_manifest(nothing).count() == personal.find_personal(nothing).count() == audit_filters(nothing, labels).count() == 0
