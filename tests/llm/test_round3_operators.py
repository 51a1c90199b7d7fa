"""Licence scans, conversation repair and the filter audit against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import permutations, product

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.oracle import connect, differences
from tripgrid.llm import conversations, filter_audit, licences, queries, twins

# -- 11 licences ----------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain_places(text):
    w = WORD.findall(lower(text))
    found = [
        (i, label)
        for phrase, label in licences.PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    return len(w), found


LICENSED = [
    None,
    "",
    " \t\n--- !!",
    "GNU General Public License",
    "gnu  general\npublic-license, GNU General Public License; Apache License",
    "the MIT license and CC-BY and cc by",
    "Kpache license, mİt license, mit licenſe",
    "xmit license mit licenses",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "This work is licensed under the GNU General Public License, version 3.",
    "word " * 5000 + "Released under the MIT License.",
    "mit license " * 3000,
    "Straße über license gnu general public",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\")",
    "Permission is hereby granted, but not free, to any person obtaining a copy of this software and associated documentation files",
]


def test_base_places_of_licences_equal_a_plain_scan(spark):
    rows = [(i, t, "r", "h", 1) for i, t in enumerate(LICENSED + LICENSED[:3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string, hits string, number int")
    out = {r["doc_id"]: r for r in licences.scan(docs, ["doc_id", "row", "hits", "number"]).collect()}
    assert len(out) == len(rows)
    for i, text, *_ in rows:
        n, found = plain_places(text)
        r = out[i]
        assert (r["n_words"], r["n_base"]) == (n, len(found)), text
        starts = [p for p, _ in found]
        assert (r["first_word"], r["last_word"]) == ((min(starts), max(starts)) if starts else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in found}))
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert 0 <= r["score"] <= 1


def test_templates_are_found_by_rare_words_in_place(spark):
    docs = spark.createDataFrame(list(enumerate(LICENSED)), "doc_id long, text string")
    got = {r["doc_id"]: r["labels"] for r in licences.scan(docs, ["doc_id"]).collect()}
    assert got[8] == "apache,apache-2.0" and got[9] == "cc-by,cc-by-nc-4.0" and got[10] == "gpl,gpl-3.0"
    assert got[11] == "mit" and got[14] == "mit" and got[15] == "" and got[13] == ""


def plain_matches(texts, rarest=8, agreeing=3):
    """(document, template, start) by looking at every start of every template."""
    docs = [WORD.findall(lower(t)) for t in texts]
    vocabulary = set(licences.vocabulary())
    frequency = Counter(w for d in docs for w in set(d) & vocabulary)
    listed = licences.index(licences.TEMPLATES, len(docs), frequency)
    found = set()
    for number, d in enumerate(docs):
        for t, (template, entry) in enumerate(zip(licences.TEMPLATES, listed, strict=True)):
            if set(entry["mandatory"]) - set(d):
                continue
            rare = [w for w in entry["ranked"] if w in d][:rarest]
            plain = template.text.split()
            keys = {i for k in template.keys for s in range(len(plain)) if plain[s : s + len(k.split())] == k.split() for i in range(s, s + len(k.split()))}
            for start in range(-len(plain), len(d)):
                there = {i for i, w in enumerate(plain) if w not in licences.COMMON and 0 <= start + i < len(d) and d[start + i] == w}
                agree = {plain[i] for i in there} & set(rare)
                if len(agree) >= min(agreeing, len(rare)) and {i for i in keys if plain[i] not in licences.COMMON} <= there:
                    found.add((number, t, start))
    return found


def test_matches_equal_a_plain_search(spark):
    rng = random.Random(5)
    texts = []
    for _ in range(60):
        t = rng.choice(licences.TEMPLATES).text.split()
        if rng.random() < 0.5:
            t[rng.randrange(len(t))] = "other"
        if rng.random() < 0.3:
            t = t[rng.randrange(3) :]
        texts.append(" ".join([*[f"w{rng.randrange(9)}" for _ in range(rng.randrange(5))], *t, *rng.choice(licences.TEMPLATES).text.split()[:6]]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = licences.licence_words(docs, ["doc_id"], licences.TEMPLATES)
    listed = licences.index(licences.TEMPLATES, len(texts), licences.document_frequencies(found))
    ids = {r["number"]: r["row"]["doc_id"] for r in found.collect()}
    got = {(ids[r["number"]], r["t"], r["start"]) for r in licences.matches(found, listed, 8, 3).collect()}
    assert got == plain_matches(texts) and got


def test_no_documents_have_no_licences(spark):
    assert licences.scan(spark.createDataFrame([], "doc_id long, text string"), ["doc_id"]).collect() == []


# -- 12 conversations -----------------------------------------------------------------------


def plain_codes(rows):
    seen, out = set(), []
    for role, text in rows:
        plain = text.strip(" \t\n\x0b\x0c\r")
        if not plain:
            out.append("b")
        elif (role, text) in seen:
            out.append("d")
        else:
            initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
            out.append(initial if plain[-1] in ".!?" else initial.upper())
        seen.add((role, text))
    return "".join(out)


def plain_repair(codes):
    """Cheapest (cost, audit) over every role string of the pattern, aligned with the rows."""

    @lru_cache(None)
    def best(i, target):
        if i == len(codes) and not target:
            return 0, ""
        options = []
        if i < len(codes):
            options.append(("D", 3, i + 1, target))
        if target and target[0] != "s":
            options.append(("I", 2, i, target[1:]))
        if i < len(codes) and target and codes[i] not in "bd":
            cut = codes[i].isupper()
            if codes[i].lower() == target[0]:
                options.append(("K", cut, i + 1, target[1:]))
            elif target[0] != "s":
                options.append(("R", 2 + cut, i + 1, target[1:]))
        found = [(best(j, rest), edit, cost) for edit, cost, j, rest in options]
        return min(((c + cost, edit + audit) for (c, audit), edit, cost in found if c < 10**6), default=(10**6, ""))

    targets = [""] + [s + "ua" * k for s in ("", "s") for k in range(1, len(codes) + 2)]
    return min(best(0, t) for t in targets)


def test_lightest_derivations_equal_all_alignments():
    for n in range(4):
        for codes in map("".join, product("suaxbUA", repeat=n)):
            assert conversations.lightest(codes, conversations.ENDS, (0,))[0] == plain_repair(codes), codes
    rng = random.Random(3)
    for _ in range(300):
        codes = "".join(rng.choice("suaxbdSUAX") for _ in range(rng.randrange(4, 12)))
        assert conversations.lightest(codes, conversations.ENDS, (0,))[0] == plain_repair(codes), codes


def plain_summary(rows):
    """Rows (turn, role, text) after damage, in order."""
    codes = plain_codes([r[1:] for r in rows])
    cost, audit = plain_repair(codes)
    turns = [r[0] for r in rows if r[0] is not None]
    out, i, role = [], 0, "u"
    for edit in audit:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            name = rows[i][1]
        else:
            name = {"u": "user", "a": "assistant"}[role]
        out.append(f"{name}:{'' if edit == 'I' else rows[i][2]}")
        role = "a" if name[0] == "u" else "u"
        i += edit != "I"
    pairs = zip(rows, rows[1:], strict=False)
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        codes.count("b"), codes.count("d"), sum(c.isupper() for c in codes),
        sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs),
        cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def plain_damage(table):
    """conv_id -> rows in order."""
    out = {}
    for conv, turn, role, text in table:
        rows = out.setdefault(conv, [])
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = (" " if v is None else v for v in (role, text))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        if kind:
            rows += [(turn, role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2])) for c, r in out.items()}


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SCHEMA = "conv_id long, turn long, role string, text string, kind string, copy string, present string, seg string"


def conversations_of(spark, table):
    return spark.createDataFrame([(*r, "k", "c", "p", "s") for r in table], SCHEMA)


def summaries(spark, table):
    out = conversations.repair(conversations.damaged(conversations_of(spark, table))).summary.collect()
    assert len({r["conv_id"] for r in out}) == len(out)
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in out}


def odd_conversations(rng, n):
    roles = ["user", "assistant", "system", None, "tool", "", "User"]
    texts = ["Hello.", "Yes!", "no end", None, "", " \t", "What?", "same.", "é ."]
    rows = []
    for conv in [None, *range(n)]:
        for k in range(rng.randrange(1, 9)):
            turn = rng.choice([k, k, k, k + 2, None])
            rows.append((conv, turn, rng.choice(roles[: rng.choice((3, 7))]), rng.choice(texts)))
    return rows + rows[:5]


def test_repairs_equal_a_plain_version(spark):
    table = odd_conversations(random.Random(11), 400)
    assert summaries(spark, table) == {c: plain_summary(r) for c, r in plain_damage(table).items()}


def test_conversations_across_stretches_and_tasks(spark, monkeypatch):
    """Every conversation in pieces of two rows must give the same as in one piece."""
    table = odd_conversations(random.Random(12), 40)
    wanted = {c: plain_summary(r) for c, r in plain_damage(table).items()}
    rows = conversations.damaged(conversations_of(spark, table)).withColumn("short", F.lit(2))
    original = conversations.stretches

    def short(df):
        # the limit travels with the function to the workers
        import types

        code = original.__globals__ | {"STRETCH_ROWS": 2}
        stretch = type("Stretch", (conversations.Stretch,), {"full": property(lambda self: len(self.roles) >= 2)})
        return types.FunctionType(original.__code__, code | {"Stretch": stretch})(df)

    monkeypatch.setattr(conversations, "stretches", short)
    out = conversations.repair(rows).summary.collect()
    assert {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in out} == wanted


def test_one_conversation_of_many_rows_is_split(spark):
    rows = [(7, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(3000)] + [(8, 0, "user", "Hi.")]
    got = summaries(spark, rows)
    wanted = {}
    for conv, after in plain_damage(rows).items():
        codes = plain_codes([r[1:] for r in after])
        wanted[conv] = (len(after), codes.count("b"), codes.count("d"))
    assert (got[7][1], got[7][2]) == wanted[7][1:]
    audit = got[7][6]
    assert len(audit.replace("I", "")) == wanted[7][0] and audit.count("D") >= wanted[7][1] + wanted[7][2]
    cost, best = conversations.lightest(plain_codes([r[1:] for r in plain_damage(rows)[7]]), conversations.ENDS, (0,))[0]
    assert (got[7][5], audit) == (cost, best)


def test_repaired_turns_follow_the_pattern(spark):
    table = odd_conversations(random.Random(13), 60)
    done = conversations.repair(conversations.damaged(conversations_of(spark, table)))
    lists = {}
    for r in done.turns.orderBy("conv_id", "seg").collect():
        lists.setdefault(r["conv_id"], []).extend(r["roles"])
    for roles in lists.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r in roles))


def test_no_conversations(spark):
    assert summaries(spark, []) == {}


# -- 13 filter audit ------------------------------------------------------------------------

DOC_SCHEMA = "doc_id long, text string, source string, part string, good string, toxic string, fails_A string, prefix string"
LABEL_SCHEMA = "doc_id long, quality int, toxic int, good string"


def plain_audit(docs, labels):
    words = re.compile(r"[^\x20\x09-\x0D]+")
    rows = []
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(d, least.get(text or "", d))
    for d, text, source in docs:
        text = text or ""
        w = words.findall(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": d is not None and least[text] < d,
        }
        rows.append((source or "", {k for k, v in fails.items() if v}, d in good, d in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        mine = [r for r in rows if r[0] == part]
        shapley = Counter()
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                all_f = sum(f in r[1] for r in mine)
                out[part, "".join(order), step] = [
                    f, len(left), len(gone), all_f - len(gone), sum(r[1] == {f} for r in mine),
                    sum(r[2] for r in gone), sum(r[3] for r in gone),
                ]
        for order in permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def odd_documents():
    rng = random.Random(9)
    base = [None, "", "short", "A B C D", " ".join(f"w{i}" for i in range(300)), "same " * 250, "Loud " * 250, "pay 5$ " * 100, "x " * 99 + "#"]
    docs = [(rng.choice([i, i, i, None]), rng.choice(base), rng.choice(["a", "b", "", None])) for i in range(120)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(60)] + [(3, 1, 1), (3, 1, 0), (None, 1, 1)]
    return docs + docs[:10], labels


@pytest.mark.parametrize("broadcast_rows", [500_000, 0])
def test_audit_equals_a_plain_version(spark, broadcast_rows):
    docs, labels = odd_documents()
    df = spark.createDataFrame([(*d, "p", "g", "t", "f", "x") for d in docs], DOC_SCHEMA)
    marks = spark.createDataFrame([(*x, "g") for x in labels], LABEL_SCHEMA)
    out = filter_audit.audit(df, marks, broadcast_rows).collect()
    names = ("filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    got = {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in out}
    assert got == plain_audit(docs, labels) and len(out) == len(got)


def test_audit_of_nothing_and_of_clean_documents(spark):
    none = spark.createDataFrame([], DOC_SCHEMA), spark.createDataFrame([], LABEL_SCHEMA)
    assert filter_audit.audit(*none).collect() == []
    clean = " ".join(f"w{i}" for i in range(300))
    docs = spark.createDataFrame([(1, clean, "a", "p", "g", "t", "f", "x")], DOC_SCHEMA)
    out = filter_audit.audit(docs, none[1]).collect()
    assert len(out) == 600 and {(r["kept"], r["removed"], r["redundant"], r["shapley"]) for r in out} == {(1, 0, 0, 0)}


def test_audit_equals_sql(spark):
    df = queries.QUERIES["op13_filter_audit"](spark, SMALL)
    assert differences(df, connect(SMALL), twins.FILTER_AUDIT) == []


def test_audit_shuffles_rows_and_ids_by_id_only_once(spark):
    docs, labels = odd_documents()
    df = filter_audit.audit(
        spark.createDataFrame([(*d, "p", "g", "t", "f", "x") for d in docs], DOC_SCHEMA),
        spark.createDataFrame([(*x, "g") for x in labels], LABEL_SCHEMA),
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    before_explode = [line for line in plan.splitlines() if "Exchange" in line and "prefix" in line]
    assert all("part" in line for line in before_explode) and "CartesianProduct" not in plan and "NestedLoop" not in plan
