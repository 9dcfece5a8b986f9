import duckdb

from tallyframe.llm import licenses
from tests.llm.helpers import documents

S = licenses.SENTENCES
MIT = f"{S['mit-grant']}\n\n{S['mit-keep']}\n\n{S['mit-as-is']}"
ROWS = [
    (1, None), (2, ""), (3, "nothing here"), (4, "x. Released under the MIT License. y"), (5, "RELEASED  under the mit license"),
    (6, MIT), (7, MIT.replace(" ", "\n")), (8, MIT.replace(", ", ",\r\n   ")), (9, f"{S['mit-grant']} {S['mit-as-is']}"),
    (10, "\n".join(S[k] for k in ("bsd-redistribute", "bsd-source", "bsd-binary"))),
    (11, "\n".join(S[k] for k in ("bsd-redistribute", "bsd-binary", "bsd-source"))),
    (12, "\n".join(S[k] for k in ("bsd-redistribute", "bsd-source", "bsd-binary", "bsd-endorse"))),
    (13, "Released under the MIT License.\n" * 30 + "Licensed under CC BY-NC 4.0."), (14, "Unreleased under the MIT License."),
    (15, "w " * 100_000 + "\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
    (16, f"{S['apache-header']} {S['apache-comply']}\n{S['apache-copy']}\n{S['apache-as-is']}\n{S['apache-limits']}"),
    (17, "SPDX-License-Identifier: MIT\ncode"), (18, "é Licensed under CC BY-NC 4.0.\n"), (19, "Licensed under CC BY-NC 4.0 x"),
    (20, f"{S['gpl2-later']} {S['gpl-warranty']} {S['gpl-details']}"), (20, "dup"), (None, "Released under the MIT License."),
    (21, S["mpl-notice"]), (22, S["mpl-notice"].replace("2.0", "1.1")), (23, S["mpl-notice"].replace("v. ", "v.\n")),
    (24, f"{S['mpl-notice']} Copyright v. 3 and v. 4. Released under the MIT License."),
]


def scan(spark, rows):
    df = documents(spark, rows).selectExpr("*", "1 as by_line", "2 as licenses")
    return sorted(
        (tuple(r) for r in licenses.scan_licenses(df).select("doc_id", "n_sentences", "licenses").collect()),
        key=lambda r: (r[0] or -1, r[1]),
    )


def test_rules_and_readings(spark):
    found = scan(spark, ROWS)
    got = {r[0]: r[2] for r in found if r[0] != 20}
    want = {
        1: "", 2: "", 3: "", 4: "MIT", 5: "MIT", 6: "MIT", 7: "MIT", 8: "MIT", 9: "", 10: "BSD-2-Clause", 11: "",
        12: "BSD-2-Clause;BSD-3-Clause", 13: "CC-BY-NC-4.0;MIT", 14: "", 15: "GPL-3.0", 16: "Apache-2.0", 17: "MIT",
        18: "CC-BY-NC-4.0", 19: "", None: "MIT", 21: "MPL-2.0", 22: "", 23: "MPL-2.0", 24: "MIT;MPL-2.0",
    }
    assert got == want
    assert [r[2] for r in found if r[0] == 20] == ["", "GPL-2.0-or-later"]
    assert {r[0]: r[1] for r in found}[13] == 31


def test_agrees_with_the_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", ROWS)
    want = con.execute(f"SELECT doc_id, n_sentences, licenses FROM ({licenses.oracle_sql()})").fetchall()
    assert scan(spark, ROWS) == sorted(want, key=lambda r: (r[0] or -1, r[1]))


def test_every_part_of_a_known_sentence_has_a_keyword():
    assert all(licenses.IDS.values())
    for p in licenses.PARTS:
        assert any(k in p for k in licenses.KEYWORDS), p


def test_every_rule_finds_its_licence(spark):
    rows = [(i, "before.\n" + "\n".join(S[k] for k in r) + "\nafter") for i, (_, r) in enumerate(licenses.RULES)]
    for r in scan(spark, rows):
        assert licenses.RULES[r[0]][0] in r[2].split(";")


def test_plan_has_no_python_and_no_shuffle(spark):
    df = licenses.scan_licenses(documents(spark, ROWS, parts=1).coalesce(1))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan


def test_empty_table(spark):
    assert scan(spark, []) == []


def test_the_version_after_v_counts(spark):
    mpl = S["mpl-notice"]
    rows = [
        (1, mpl), (2, mpl.replace("2.0", "1.1")), (3, mpl.replace("v. ", "v.\n") + " If a copy"), (4, mpl.replace("2.0.", "2.0.1.")),
        (5, mpl.replace("v. 2.0.", "v.")), (6, "x v. Released under the MIT License."), (7, "v. 2. Released under the MIT License."),
        (8, "see v. 3; Licensed under CC BY 4.0. y"), (9, mpl.replace("2.0", "1.1") + " " + mpl),
    ]
    got = {r[0]: r[1:] for r in scan(spark, rows)}
    none = (0, "")
    assert got == {
        1: (1, "MPL-2.0"), 2: none, 3: (1, "MPL-2.0"), 4: none, 5: none, 6: (1, "MIT"), 7: (1, "MIT"), 8: (1, "CC-BY-4.0"),
        9: (1, "MPL-2.0"),
    }
    # no sentence that is looked up starts with a number, so a dot that no longer ends one hides none
    assert not any(p[0].isdigit() for p in licenses.WHOLE)
    assert [p for p, w in zip(licenses.PARTS, licenses.WHOLE, strict=True) if p != w] == [p for p in licenses.PARTS if p.endswith(" v")]
