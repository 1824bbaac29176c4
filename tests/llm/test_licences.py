import textwrap

from demandloom.llm import licences, registry
from tests.checking import compare, duck
from tests.llm.helpers import SF_DIR, as_set, no_documents, odd_documents, odd_rows


def brute(text):
    """Sentences, identifiers and licences by plain loops."""
    import re

    found = []
    for unit in re.split(licences.SENTENCE_END, text or ""):
        whole = licences.known().get(licences.plain(unit))
        if whole:
            found.append(whole)
            continue
        for line in unit.split("\n"):
            if licences.plain(line):
                found.append(licences.known().get(licences.plain(line)))
    sequence, unknown = [], 0
    for name in [*found, "end"]:
        if name is None:
            unknown += 1
            continue
        if unknown and name == "bsd-as-is" and sequence and sequence[-1] == "bsd-binary":
            sequence[-1], unknown = "break", 0
            continue
        if unknown >= licences.BREAK:
            sequence.append("break")
        unknown = 0
        if name != "end":
            sequence.append(name)
    named = {code: name for name, code in licences.codes().items()}
    rules = [([named[code[i : i + 5]] for i in range(0, len(code), 5)], licence) for code, licence in licences.rules()]
    matched, at = [], 0
    while at < len(sequence):
        for rule, licence in rules:
            if sequence[at : at + len(rule)] == rule:
                matched.append(licence)
                at += len(rule)
                break
        else:
            at += 1
    return len(found), [n for n in found if n], matched


MIT = "Copyright (c) 2020 Somebody\n\n" + "\n\n".join(
    [licences.SENTENCES[n].replace(" software ", "\nsoftware ") for n in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")]
)
TEXTS = [
    MIT,
    "Some words. Licensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
    "# Licensed under the Apache License, Version 2.0 (the \"License\");\n# you may not use this file except in compliance with the License.\n"
    "# You may obtain a copy of the License at\n#\n#     http://example.org/licence\n#\n"
    "# Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
    "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
    "See the License for the specific language governing permissions and limitations under the License.",
    "// SPDX-License-Identifier: BSD-3-Clause\nint x;",
    # the order of the rule matters, and too much between two sentences breaks it
    licences.SENTENCES["mit-notice"] + " " + licences.SENTENCES["mit-grant"],
    licences.SENTENCES["bsd-grant"] + "\n\na. b. c. d.\n\n" + licences.SENTENCES["bsd-source"] + " " + licences.SENTENCES["bsd-binary"],
    licences.SENTENCES["bsd-grant"] + "\n\n1. x. " + licences.SENTENCES["bsd-source"] + " " + licences.SENTENCES["bsd-binary"] + "\n",
    "THIS WORK IS LICENSED UNDER THE GNU GENERAL PUBLIC LICENSE, VERSION 3!\n\nno licence here",
    "It is not Released under the MIT License.",
]


def test_equals_sql(spark):
    assert compare(registry.licence_scan(spark, SF_DIR), duck(SF_DIR), licences.oracle()) is None


def test_rules_and_order_against_brute_force(spark):
    texts = TEXTS + [r[1] for r in odd_rows()]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in licences.scan(table).collect():
        count, named, matched = brute(texts[r.doc_id])
        assert (r.n_sentences, r.n_known, r.sentences, r.licences) == (count, len(named), " ".join(named), " ".join(matched)), r.doc_id
    by_text = {r.doc_id: r.licences for r in licences.scan(table).collect()}
    assert [by_text[i] for i in range(len(TEXTS))] == ["MIT", "Apache-2.0 MIT", "Apache-2.0", "BSD-3-Clause", "", "", "BSD-2-Clause", "GPL-3.0", ""]


def wrapped(names, mark="", between="", numbers=()):
    """The sentences as paragraphs of short lines, each line after a comment mark, some paragraphs after a list number."""
    lines = []
    for name in names:
        text = licences.SENTENCES.get(name) or f"SPDX-License-Identifier: {name[4:]}"
        number = f"{len(lines)}. "[-3:] if name in numbers else ""
        lines += [mark + line for line in textwrap.wrap(number + text, 60)] + [between]
    return "\n".join(lines)


MARKS = [("", ""), (" * ", " *"), ("# ", "#"), ("// ", "//"), ("! ", "!"), ("REM ", "REM"), ("-- ", "--"), ("; ", ";")]


def test_every_sentence_wrapped_and_in_comments(spark):
    cases = [(name, mark, between) for name in licences.known().values() for mark, between in MARKS]
    texts = [(i, f"{between}\n{mark}Some heading\n{between}\n" + wrapped([n], mark, between)) for i, (n, mark, between) in enumerate(cases)]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    wrong = [case for i, case in enumerate(cases) if found[i].sentences != case[0] or found[i].n_sentences != 2]
    assert not wrong


def test_every_rule_wrapped_and_in_comments(spark):
    rules = [(licence, names) for licence, listed in licences.RULES.items() for names in listed]
    cases = [(licence, names, mark, between) for licence, names in rules for mark, between in MARKS]
    texts = [(i, f"/*\n{mark}Copyright (c) 2020 Somebody\n{between}\n" + wrapped(names, mark, between) + "\nint x;") for i, (_, names, mark, between) in enumerate(cases)]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    wrong = [case for i, case in enumerate(cases) if (found[i].licences, found[i].sentences) != (case[0], " ".join(case[1]))]
    assert not wrong


def test_lists_and_conditions(spark):
    names = ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"]
    mit = [licences.SENTENCES[n] for n in ("mit-grant", "mit-notice", "mit-as-is", "mit-liability")]
    texts = [
        # a list right after the colon, without empty lines, in three ways to number it
        "\n".join(x for x in wrapped(names, numbers=names[1:4]).split("\n") if x),
        "\n".join("# " + x for x in wrapped(names, numbers=names[1:4]).split("\n") if x),
        "\n".join(f"({n}) " * (0 < n < 4) + textwrap.fill(licences.SENTENCES[name], 50) for n, name in enumerate(names)),
        " ".join(mit),
        textwrap.fill(" ".join(mit), 70),
        "This Source Code Form is subject to the terms of the Mozilla Public\n * License, v.\n * 2.0. If a copy of the MPL was not distributed",
        "It is not\nReleased under the MIT License, or\nLicensed under the MIT\n\nLicense.",
        "Smith v. Jones, see p. 3",
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r for r in licences.scan(table).collect()}
    assert [found[i].licences for i in range(len(texts))] == ["BSD-3-Clause"] * 3 + ["MIT", "MIT", "MPL-2.0", "", ""]
    assert found[7].n_sentences == 3


def test_no_rows_and_clashing_columns(spark):
    assert licences.scan(no_documents(spark)).count() == 0
    docs = odd_documents(spark).withColumnRenamed("lang", "licences").withColumnRenamed("source", "_codes")
    assert licences.scan(docs).columns == ["doc_id", "text", "_codes", "n_chars", "n_sentences", "n_known", "sentences", "licences"]
    assert as_set(licences.scan(docs).select("doc_id", "_codes").collect()) == as_set((r[0], r[3]) for r in odd_rows())


def test_plan_is_native(spark):
    plan = registry.licence_scan(spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def bsd(holder="the copyright holder", by="THE COPYRIGHT HOLDERS AND CONTRIBUTORS", third=None, advert=""):
    text = licences.SENTENCES
    name = third if third is not None else text["bsd-name"].replace("the copyright holder", holder)
    as_is = text["bsd-as-is"].replace("THE COPYRIGHT HOLDERS AND CONTRIBUTORS", by)
    return "\n\n".join(x for x in (text["bsd-grant"], "1. " + text["bsd-source"], "2. " + text["bsd-binary"], advert, name, as_is) if x)


def noticed(noun, free, see="GNU General Public License"):
    text = licences.SENTENCES
    return "\n\n".join([
        text[free].replace("This program", noun), text["gpl-hope"].replace("This program", noun) + " See the " + see + " for more details.",
    ])


TAG = "SPDX-License-Identifier: "
REAL = [
    (bsd("Example Corp."), "BSD-3-Clause"),
    (bsd("Example, Inc. nor of its parent"), "BSD-3-Clause"),
    (bsd("the University of California, Berkeley", "THE REGENTS AND CONTRIBUTORS"), "BSD-3-Clause"),
    (bsd("Smith v. Jones\n * and Sons Ltd."), "BSD-3-Clause"),
    (bsd(by="JOHN DOE"), "BSD-3-Clause"),
    (bsd(third=""), "BSD-2-Clause"),
    (bsd(third="", by="Jane Doe"), "BSD-2-Clause"),
    (bsd(third="3. You have to send the author a postcard."), ""),
    (bsd(advert="3. All advertising materials mentioning features or use of this software must display the following acknowledgement: "
         "This product includes software developed by the Example Org."), "BSD-4-Clause"),
    (MIT.replace("this permission notice", "this permission notice (including the next paragraph)"), "MIT"),
    (MIT.replace('"AS IS"', "\u201cAS IS\u201d").replace('"Software"', "\u201cSoftware\u201d"), "MIT"),
    (noticed("This library", "lgpl2-free", "GNU Lesser General Public License"), "LGPL-2.1-or-later"),
    (noticed("libfoo", "lgpl3-free", "GNU Lesser General Public License"), "LGPL-3.0-or-later"),
    (noticed("This program", "agpl3-free", "GNU Affero General Public License"), "AGPL-3.0-or-later"),
    (noticed("GNU Tool", "gpl-free"), "GPL-3.0-or-later"),
    (noticed("This file", "gpl2-free"), "GPL-2.0-or-later"),
    (noticed("This program", "gpl2-only"), "GPL-2.0-only"),
    (noticed("This software", "gpl2-only-of"), "GPL-2.0-only"),
    (noticed("This module", "gpl2-only-end"), "GPL-2.0-only"),
    (noticed("This program", "gpl3-only"), "GPL-3.0-only"),
    ("// " + TAG + "MIT OR Apache-2.0\nint x;", "MIT Apache-2.0"),
    ("# " + TAG + "GPL-2.0-only\n", "GPL-2.0-only"),
    ("/* " + TAG + "GPL-2.0-only WITH Classpath-exception-2.0 */", "GPL-2.0-only"),
    ("-- " + TAG + "(MIT AND BSD-3-Clause) OR LGPL-2.1+ --", "MIT BSD-3-Clause LGPL-2.1-or-later"),
    (TAG + "GPL-3.0+", "GPL-3.0-or-later"),
    (TAG + "NoSuchLicence-1.0 OR ISC", "ISC"),
    ('Apache License\nVersion 2.0, January 2004\n\n1. Definitions.\n\n"License" shall mean the terms and conditions for use, reproduction,\n'
     'and distribution as defined by Sections 1 through 9 of this document.\n\n"Licensor" shall mean the copyright owner or entity authorized by\n'
     "the copyright owner that is granting the License.\n", "Apache-2.0"),
    ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, "
     "but changing it is not allowed.\n\nPreamble\n\nThe GNU General Public License is a free, copyleft license for\nsoftware and other kinds of works.\n", "GPL-3.0"),
    ("The licenses for most software are designed to take away your\nfreedom to share and change it.  By contrast, the GNU General Public\nLicense is "
     "intended to guarantee your freedom to share and change free\nsoftware--to make sure the software is free for all its users.  This", "GPL-2.0"),
    ("The licenses for most software are designed to take away your\nfreedom to share and change it.  By contrast, the GNU General Public\nLicenses are "
     "intended to guarantee your freedom to share and change free\nsoftware--to make sure the software is free for all its users.", "LGPL-2.1"),
    ('1.1. "Contributor"\n    means each individual or legal entity that creates, contributes to\n    the creation of, or owns Covered Software.\n\n1.2. "Contributor '
     'Version"\n    means the combination of the Contributions of others (if any) used\n    by a Contributor and that particular Contributor\'s Contribution.', "MPL-2.0"),
    ("The name of the rose, neither the names of its friends. This software is provided by my mother.", ""),
    ("You can redistribute these flyers. The hall is free; software is provided as is.", ""),
]


def test_licences_as_they_are_found(spark):
    marks = ["", " * ", "# "]
    texts = [(3 * i + k, "\n".join(mark + line for line in text.split("\n"))) for i, (text, _) in enumerate(REAL) for k, mark in enumerate(marks)]
    found = {r.doc_id: r for r in licences.scan(spark.createDataFrame(texts, "doc_id long, text string")).collect()}
    wrong = [(i, REAL[i // 3][1], found[i].licences, found[i].sentences) for i, _ in texts if found[i].licences != REAL[i // 3][1]]
    assert not wrong


def test_sql_knows_wrapped_and_commented_sentences(spark, tmp_path):
    import duckdb

    texts = [(i, text) for i, (text, _) in enumerate(REAL)]
    texts += [(1000 + i, "/*\n" + wrapped(names, mark, between)) for i, (names, (mark, between)) in enumerate(
        (names, pair) for listed in licences.RULES.values() for names in listed for pair in MARKS
    )]
    texts += [(5000 + i, r[1]) for i, r in enumerate(odd_rows())]
    table = spark.createDataFrame(texts, "doc_id long, text string")
    table.write.parquet(str(tmp_path / "d.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/d.parquet/*.parquet')")
    assert compare(licences.scan(table).drop("text"), con, licences.oracle()) is None


def test_names_are_sought_once_a_word(spark):
    """The quick patterns replace the same matches, next to each other and inside words too."""
    import re
    import time

    from pyspark.sql import functions as F

    free = "is free software: you can redistribute"
    texts = [
        f"Foo Bar {free}", f"a b c d e f {free}", f"x\n {free}", f"two\n\n {free}", f"-x_y+z  4\t{free}s {free} it {free}",
        f"{free}{free}", f"foo {free}d {free}", f"THE Foo IS FREE SOFTWARE; YOU CAN REDISTRIBUTE", f"é{free} éx {free}",
        "this foo bar baz is distributed in the hope", "bathe a-b is distributed in the hope", "the is distributed in the hope", "",
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for pattern, by in licences.REWRITES:
        quick, plain = (F.regexp_replace("text", p, by) for p in (licences._by_words(pattern), pattern))
        assert [r for r in rows.select("text", quick.alias("q"), plain.alias("p")).collect() if r.q != r.p] == []
        assert len(licences._by_words(pattern)) > len(pattern) or not re.search(r"\[a-z0-9_\+-\]\+", pattern)

    long = spark.createDataFrame([(" ".join(["considerations"] * 40_000),)], "text string")

    def seconds(column):
        begun = time.perf_counter()
        long.select(F.length(column)).collect()
        return time.perf_counter() - begun

    plain = F.col("text")
    for pattern, by in licences.REWRITES:
        plain = F.regexp_replace(plain, pattern, by)
    assert min(seconds(licences._rewritten(F.col("text"))) for _ in range(2)) < 0.7 * min(seconds(plain) for _ in range(2))


def test_only_ascii_letters_and_digits_are_kept(spark):
    text = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x11000)]))
    kept = spark.createDataFrame([(text,)], "text string").selectExpr(f"regexp_replace(text, r'{licences.OTHERS}', '')").first()[0]
    assert kept == "\n0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
    odd = spark.createDataFrame([("KELVIN İs ÀB",)], "text string")
    assert odd.select(licences._normalised(odd.text)).first()[0].strip() == "elvin s b"
