"""The manifest against a plain tree, against SQL, and its appends one by one."""

import random
import zlib
from hashlib import sha256

import duckdb
import pytest
from pyspark.sql import functions as F

from innledger.llm import merkle
from innledger.llm.queries import ORACLE, QUERIES

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " tree string, position int, digest string"
)


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def folded_up(nodes):
    """The levels of a tree, from the leaves to the top."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def witness(levels, i):
    steps = []
    for nodes in levels[:-1]:
        first = i - i % 8
        steps.append(("".join(nodes[first:i]), "".join(nodes[i + 1 : first + 8])))
        i //= 8
    return steps


def plain(rows):
    """The whole report, one row after the other."""

    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    trees = {}
    for row in rows:
        doc_id, text, lang, source, n_chars = row[:5]
        about = "".join(map(field, (doc_id, source, lang, n_chars)))
        lower = text if text is None else "".join(
            c.lower() if "A" <= c <= "Z" else c for c in text
        )
        hit = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0
        leaf = digest(about, field(text))
        shown = digest(about, field(lower)) if hit else leaf
        trees.setdefault(lang, []).append((doc_id is not None, doc_id or 0, leaf, shown, doc_id))
    names = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    grown = {lang: folded_up([t[2] for t in sorted(trees[lang])]) for lang in names}
    top = folded_up([grown[lang][-1][0] for lang in names])
    out = []
    for at, lang in enumerate(names):
        for i, (_, _, leaf, shown, doc_id) in enumerate(sorted(trees[lang])):
            steps = witness(grown[lang], i) + witness(top, at)
            proof = digest(*(x for step in steps for x in step))
            for before, after in steps:
                shown = digest(before, shown, after)
            root = top[-1][0]
            out.append((doc_id, leaf, grown[lang][-1][0], root, proof, shown, shown == root))
    return out


def in_order(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("n", [1, 8, 9, 64, 65, 700])
def test_appended_witnesses_are_those_of_the_whole_tree(n):
    leaves = [digest(str(i)) for i in range(n)]
    levels = folded_up(leaves)
    tree = merkle.OpenTree()
    for leaf in leaves:
        tree.append(leaf)
    assert tree.closed(merkle.height(n)) == levels[-1][0]
    assert tree.witness == [witness(levels, i) for i in range(n)]


def test_witnesses_grow_with_later_appends():
    tree = merkle.OpenTree()
    known = []
    for i in range(65):
        tree.append(digest(str(i)))
        known.append(len(tree.witness[0]))
    # The first run completes with the eighth leaf, the run of runs with the 64th.
    assert known == [0] * 7 + [1] * 56 + [2] * 2


def odd_rows():
    chance = random.Random(5)
    words = ["Plain", "ÉTÉ Zürich", "", "MIXED case", None, "long " * 20000]
    rows = [
        (i, chance.choice(words), chance.choice(["de", "en", "en", None, "", "zz"]),
         chance.choice(["web", None, "Ω"]), chance.choice([None, i, -1]), "x", 7, "clash")
        for i in chance.sample(range(-50, 3000), 300)
    ]
    rows += [(None, None, None, None, None, None, None, None)] * 9
    rows += [(5, "TWICE", "en", "web", 1, None, None, None)] * 20
    return rows


def test_report_against_the_plain_one(spark):
    rows = odd_rows()
    got = merkle.tamper_report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert in_order(got) == in_order(plain(rows))


def test_blocks_of_several_rounds(spark):
    rows = [(i, f"Text {i}", "en" if i % 7 else "fr", "web", i, "", 0, "") for i in range(600)]
    leaves = spark.createDataFrame(rows, SCHEMA).drop("position")
    leaves = leaves.withColumn("leaf", F.sha2("text", 256))
    found = merkle.manifest(leaves, "lang", ["doc_id"], "leaf", levels=1)
    assert found.select(leaves.columns).schema == leaves.schema
    ok = found.select(merkle.folded("leaf").alias("f"), "root", "subroot", "lang").distinct()
    rows = ok.collect()
    assert len(rows) == 2 and all(r.f == r.root for r in rows)
    plain_tops = {
        lang: folded_up([digest(f"Text {i}") for i in range(600) if bool(i % 7) == (lang == "en")])
        for lang in ("en", "fr")
    }
    assert {r.lang: r.subroot for r in rows} == {x: t[-1][0] for x, t in plain_tops.items()}


def test_a_single_row_is_its_own_root(spark):
    (row,) = merkle.tamper_report(spark.createDataFrame(odd_rows()[:1], SCHEMA)).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == digest()


def test_empty_table(spark):
    assert merkle.tamper_report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table_against_sql(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    found = QUERIES["op12_merkle_manifest"](spark, folder)
    names = ", ".join(found.columns)
    want = con.execute(f"SELECT {names} FROM ({ORACLE['op12_merkle_manifest']})").fetchall()
    assert in_order(found.collect()) == in_order(want)
