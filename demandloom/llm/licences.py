"""Licence scan: known sentences become identifiers, ordered identifiers become licences.

A text is cut into sentences, each is normalised (ASCII letters and digits, lower
case, single spaces) and looked up among known licence sentences, whatever comment
marks, list numbers or line ends it is written with. Where a sentence names somebody
or something, as the holder in a BSD licence, it is a template whose gap is filled with a
fixed word first. The sequence of identifiers, in which up to two unknown sentences may
stand between known ones, is then matched against the ordered rules of the
licences, longest rule first.
"""

from __future__ import annotations

from functools import lru_cache
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandloom.llm.common import unused

# Sentences of public licences and of the notices that refer to them.
SENTENCES = {
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "mit-liability": "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "mit-reference": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "isc-as-is": "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "bsd-name": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "bsd-as-is": "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.",
    "apache-short": "Licensed under the Apache License, Version 2.0.",
    "apache-long": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-may-not": "you may not use this file except in compliance with the License.",
    "apache-long-may-not": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-as-is": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "apache-see": "See the License for the specific language governing permissions and limitations under the License.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl2-work": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "gpl-see": "See the GNU General Public License for more details.",
    "lgpl-work": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-work": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by-nd": "Licensed under CC BY-ND 4.0.",
    "cc-by-nc-sa": "Licensed under CC BY-NC-SA 4.0.",
    "cc-by-nc-nd": "Licensed under CC BY-NC-ND 4.0.",
    "cc-by-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-long": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-long": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc0-waived": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "lgpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "gpl2-only-of": "This program is free software; you can redistribute it and/or modify it under the terms of version 2 of the GNU General Public License as published by the Free Software Foundation.",
    "gpl2-only-end": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; version 2 of the License.",
    "gpl3-only": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, version 3 of the License.",
    "lgpl-see": "See the GNU Lesser General Public License for more details.",
    "agpl-see": "See the GNU Affero General Public License for more details.",
    "bsd-advertising": "All advertising materials mentioning features or use of this software must display the following acknowledgement:",
    "apache-defines-license": "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.",
    "apache-defines-licensor": "\"Licensor\" shall mean the copyright owner or entity authorized by the copyright owner that is granting the License.",
    "gpl-verbatim": "Everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed.",
    "gpl3-copyleft": "The GNU General Public License is a free, copyleft license for software and other kinds of works.",
    "agpl3-copyleft": "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software.",
    "lgpl3-incorporates": "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below.",
    "gpl2-take-away": "The licenses for most software are designed to take away your freedom to share and change it.",
    "gpl2-contrast": "By contrast, the GNU General Public License is intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
    "lgpl2-contrast": "By contrast, the GNU General Public Licenses are intended to guarantee your freedom to share and change free software--to make sure the software is free for all its users.",
    "mpl-contributor": "\"Contributor\" means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software.",
    "mpl-contributor-version": "\"Contributor Version\" means the combination of the Contributions of others (if any) used by a Contributor and that particular Contributor's Contribution.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# The licences by their public short names and the sentences that state them, in order.
RULES = {
    "MIT": [["mit-grant", "mit-notice", "mit-as-is", "mit-liability"], ["mit-grant", "mit-notice"], ["mit-reference"], ["mit-licensed"]],
    "ISC": [["isc-grant", "isc-as-is"], ["isc-grant"]],
    "BSD-2-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-as-is"], ["bsd-grant", "bsd-source", "bsd-binary"]],
    "BSD-4-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name", "bsd-as-is"], ["bsd-grant", "bsd-source", "bsd-binary", "bsd-advertising", "bsd-name"]],
    "BSD-3-Clause": [["bsd-grant", "bsd-source", "bsd-binary", "bsd-name", "bsd-as-is"], ["bsd-grant", "bsd-source", "bsd-binary", "bsd-name"]],
    "Apache-2.0": [
        ["apache-long", "apache-may-not", "apache-copy", "apache-as-is", "apache-see"],
        ["apache-long-may-not", "apache-copy", "apache-as-is", "apache-see"],
        ["apache-long-may-not"],
        ["apache-defines-license", "apache-defines-licensor"],
        ["apache-short"],
    ],
    "GPL-3.0": [["gpl3-work"], ["gpl-verbatim", "gpl3-copyleft"]],
    "GPL-2.0": [["gpl2-work"], ["gpl2-take-away", "gpl2-contrast"]],
    "GPL-3.0-only": [["gpl3-only", "gpl-hope", "gpl-see"], ["gpl3-only"]],
    "GPL-2.0-only": [
        ["gpl2-only", "gpl-hope", "gpl-see"], ["gpl2-only-of", "gpl-hope", "gpl-see"], ["gpl2-only-end", "gpl-hope", "gpl-see"],
        ["gpl2-only"], ["gpl2-only-of"], ["gpl2-only-end"],
    ],
    "GPL-3.0-or-later": [["gpl-free", "gpl-hope", "gpl-see"], ["gpl-free"]],
    "GPL-2.0-or-later": [["gpl2-free", "gpl-hope", "gpl-see"], ["gpl2-free"]],
    "LGPL-3.0": [["lgpl-work"], ["lgpl3-incorporates"]],
    "LGPL-2.1": [["gpl2-take-away", "lgpl2-contrast"]],
    "LGPL-2.1-only": [],
    "LGPL-3.0-only": [],
    "LGPL-2.1-or-later": [["lgpl2-free", "gpl-hope", "lgpl-see"], ["lgpl2-free"]],
    "LGPL-3.0-or-later": [["lgpl3-free", "gpl-hope", "lgpl-see"], ["lgpl3-free"]],
    "AGPL-3.0": [["agpl-work"], ["gpl-verbatim", "agpl3-copyleft"]],
    "AGPL-3.0-only": [],
    "AGPL-3.0-or-later": [["agpl3-free", "gpl-hope", "agpl-see"], ["agpl3-free"]],
    "MPL-2.0": [["mpl-form"], ["mpl-contributor", "mpl-contributor-version"]],
    "CC-BY-4.0": [["cc-by"], ["cc-by-long"]],
    "CC-BY-SA-4.0": [["cc-by-sa"], ["cc-by-sa-long"]],
    "CC-BY-NC-4.0": [["cc-by-nc"], ["cc-by-nc-long"]],
    "CC-BY-ND-4.0": [["cc-by-nd"]],
    "CC-BY-NC-SA-4.0": [["cc-by-nc-sa"]],
    "CC-BY-NC-ND-4.0": [["cc-by-nc-nd"]],
    "CC0-1.0": [["cc0-waived"]],
    "Unlicense": [["unlicense"]],
}

#: A sentence ends at one of .!? before white space, or at an empty line.
SENTENCE_END = r"[.!?]+[\x20\x09-\x0D]+|\n[\x20\x09\x0B-\x0D]*\n"
#: Comment marks and white space where a line begins. A line of nothing else is an empty one.
LINE_MARKS = r"\n[\x20\x09\x0B-\x0D!-/:-@\[-`{-~]*(?:(?:REM|Rem|rem|dnl)(?![^\x20\x09\x0D\n])[\x20\x09\x0B-\x0D!-/:-@\[-`{-~]*)?"
#: The full stop of "v. 2.0" ends no sentence; the colon of a licence's conditions ends a line.
VERSION_STOP = r"([vV])(?<![A-Za-z0-9][vV])\.(?=[\x20\x09-\x0D]+[0-9])"
CONDITIONS = r"(?i)(following\s+conditions(?:\s+are\s+met)?:)[\x20\x09]+(?=[^\x20\x09-\x0D])"
#: Texts without any of these are left as they are by the rewrites below.
HINT = "(?i)licen[cs]e|redistribut|permission|as is|neither"
WS = r"[\x20\x09-\x0D]+"
#: Between the words of a name: no empty line.
GAP = r"(?:[\x20\x09]+|[\x20\x09\x0D]*\n[\x20\x09]*)"
#: What the words of a name are made of.
LETTER = "[a-z0-9_+-]"
#: Templates: what stands in a gap of a sentence, up to the given length, becomes a fixed word, and what may be left out goes.
REWRITES = [
    # the holder in a BSD licence, the name of a program, the product of an advertisement
    (rf"(?is)(neither{WS}the{WS}names?{WS}of){WS}.{{1,300}}?{WS}nor{WS}the{WS}names?{WS}of{WS}(?:its|their|any|other|the){WS}contributors", "$1 the copyright holder nor the names of its contributors"),
    (rf"(?is)(this{WS}software{WS}is{WS}provided{WS}by){WS}.{{1,200}}?{WS}([^\x20\x09-\x0Da-z0-9]*as{WS}is)", "$1 the copyright holders and contributors $2"),
    (rf"(?is)(must{WS}display{WS}the{WS}following{WS}acknowledge?ment:)[^a-z0-9]*this{WS}product{WS}includes.{{1,300}}?[.](\x20|\x09|\n|$)", "$1\n\n"),
    (rf"(?i){LETTER}+(?:{GAP}{LETTER}+){{0,3}}{GAP}is{WS}free{WS}software([:;,]?){WS}you{WS}can{WS}redistribute", "This program is free software$1 you can redistribute"),
    (rf"(?i)(?:this|the){GAP}{LETTER}+(?:{GAP}{LETTER}+){{0,2}}{GAP}is{WS}distributed{WS}in{WS}the{WS}hope", "This program is distributed in the hope"),
    # optional words
    (rf"(?i){WS}[(]including{WS}the{WS}next{WS}paragraph[)]", ""),
    (rf"(?i)(without){WS}specific{WS}(prior{WS}written{WS}permission)", "$1 specific $2"),
]
#: An expression of several SPDX identifiers becomes a line for each; exceptions are left out.
EXPRESSION = r"(SPDX-License-Identifier:[\x20\x09(]*[A-Za-z0-9.+-]+)[\x20\x09)]+(?:OR|AND|or|and)[\x20\x09(]+"
EXCEPTION = r"(SPDX-License-Identifier:[\x20\x09(]*[A-Za-z0-9.+-]+)[\x20\x09]+(?:WITH|with)[\x20\x09]+[A-Za-z0-9.+-]+"
#: So many times the first operator of every expression is taken apart.
OPERATORS = 6
#: The old way to write the last identifiers of a family.
LATER = r"(SPDX-License-Identifier:[\x20\x09(]*A?L?GPL-[0-9.]+)[+]"
TAG_STEPS = [(EXCEPTION, "$1"), *[(EXPRESSION, "$1\n\nSPDX-License-Identifier: "), (EXCEPTION, "$1")] * OPERATORS, (LATER, "$1-or-later")]
#: A list number before a sentence, as it is left by ``plain``.
NUMBER = "(?:[0-9]{1,2}|[a-z]|[ivx]{1,4}) "
#: All but letters, digits of ASCII and line feeds. As ranges, which Java finds sooner than the negated class.
OTHERS = r"[\x00-\x09\x0B-/:-@\[-`{-\x{10FFFF}]+"
UNKNOWN = "~"
#: So many unknown sentences in a row break a sequence.
BREAK = 3


def plain(sentence: str) -> str:
    """A sentence as it is looked up."""
    small = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in sentence)
    return re.sub("[^a-z0-9]+", " ", small).strip(" ")


@lru_cache(maxsize=1)
def known() -> dict[str, str]:
    """Normalised sentence to identifier; a tag line for each licence besides the listed sentences."""
    texts = {plain(text): name for name, text in SENTENCES.items()}
    texts |= {plain(f"SPDX-License-Identifier: {licence}"): f"tag-{licence}" for licence in RULES}
    return texts


@lru_cache(maxsize=1)
def codes() -> dict[str, str]:
    """Identifier to its code in a sequence, all of one length."""
    return {name: f"s{number:03d}|" for number, name in enumerate(known().values())}


@lru_cache(maxsize=1)
def rules() -> list[tuple[str, str]]:
    """(sequence of codes, licence), longest sequence first."""
    listed = [(sequence, licence) for licence, sequences in RULES.items() for sequence in sequences]
    listed += [([f"tag-{licence}"], licence) for licence in RULES]
    coded = [("".join(codes()[name] for name in sequence), licence) for sequence, licence in listed]
    return sorted(coded, key=lambda r: (-len(r[0]), r[0]))


def _pattern() -> str:
    return "(" + "|".join(sequence.replace("|", r"\|") for sequence, _ in rules()) + ")"


def _unknown_clause() -> tuple[str, str]:
    """A pattern for conditions, an unknown clause and the disclaimer of a BSD licence, and what takes their place."""
    binary, as_is = (codes()[name].replace("|", r"\|") for name in ("bsd-binary", "bsd-as-is"))
    return f"{binary}{UNKNOWN}+{as_is}", "#"


@lru_cache(maxsize=1)
def _pieces() -> str:
    """Matches adjacent lines that make one known sentence, the longest first, or else a single line."""
    listed = sorted(known(), key=lambda text: (-len(text), text))
    sentences = "|".join(text.replace(" ", r"[\x20\n]") for text in listed)
    return f"(?m)^(?:{NUMBER})?(?:{sentences})$|^.+$"


def _by_words(pattern: str) -> str:
    """The same matches, sought once a word: a name is tried where a word begins or the last match ended, and as a whole."""
    if pattern.startswith(f"(?i){LETTER}"):
        pattern = pattern.replace("(?i)", rf"(?i)(?:\G|(?<!{LETTER}))", 1)
    return pattern.replace(f"{LETTER}+", f"{LETTER}++")


def _rewritten(text: Column) -> Column:
    """The text with its templates' gaps filled and its SPDX expressions taken apart."""
    filled = text
    for pattern, by in REWRITES:
        filled = F.regexp_replace(filled, _by_words(pattern), by)
    tags = filled
    for pattern, by in TAG_STEPS:
        tags = F.regexp_replace(tags, pattern, by)
    return F.when(filled.contains("SPDX-License-Identifier:"), tags).otherwise(filled)


def _normalised(text: Column) -> Column:
    """The text's lines as ``plain`` leaves them, with an empty line between sentences."""
    bare = F.regexp_replace(F.concat(F.lit("\n"), text), LINE_MARKS, "\n")
    bare = F.when(bare.rlike(HINT), _rewritten(bare)).otherwise(bare)
    bare = F.regexp_replace(F.regexp_replace(bare, VERSION_STOP, "$1"), CONDITIONS, "$1\n")
    # only ASCII is left to be lower-cased
    small = F.lower(F.regexp_replace(F.regexp_replace(bare, SENTENCE_END, "\n\n"), OTHERS, " "))
    return F.trim(F.regexp_replace(small, r"\x20?\n\x20?", "\n"))


def scan(docs: DataFrame) -> DataFrame:
    """Adds ``n_sentences``, ``n_known``, ``sentences`` and ``licences`` to every row of ``docs`` (column text).

    ``sentences`` lists the identifiers of the known sentences in order,
    ``licences`` the licences whose rules match, in the order of the text and with
    repeats; both are joined by a space. A sentence may run over several lines,
    with or without comment marks, after a list number, and next to lines that
    belong to no known sentence; each of these counts as an unknown sentence. What
    fills the gap of a template may have up to 300 characters. An unknown clause
    between the conditions and the disclaimer of a BSD licence makes it none of the known ones.

    Null and empty texts have no sentences and empty lists. Repeated rows are
    scanned each. Columns with one of the four names are overwritten. Empty
    table: no rows.
    """
    sentence_codes = F.create_map(*[F.lit(x) for text, name in known().items() for x in (text, codes()[name])])
    names = F.create_map(*[F.lit(x) for name, code in codes().items() for x in (code, name)])
    licences = F.create_map(*[F.lit(x) for rule in rules() for x in rule])

    def code(piece: Column) -> Column:
        line = F.replace(piece, F.lit("\n"), F.lit(" "))
        bare = F.when(line.rlike("^" + NUMBER), F.regexp_replace(line, "^" + NUMBER, ""))
        return F.coalesce(F.try_element_at(sentence_codes, line), F.try_element_at(sentence_codes, bare), F.lit(UNKNOWN))

    pieces = F.regexp_extract_all(_normalised(F.coalesce(F.col("text"), F.lit(""))), F.lit(_pieces()), F.lit(0))
    rest = docs.drop("n_sentences", "n_known", "sentences", "licences")
    own = unused("_codes", rest.columns)
    cut = rest.withColumn(own, F.transform(pieces, code))
    closed = F.regexp_replace(F.array_join(own, ""), *_unknown_clause())
    broken = F.regexp_replace(F.regexp_replace(closed, UNKNOWN + "{%d,}" % BREAK, "#"), UNKNOWN, "")
    listed = F.filter(own, lambda c: c != UNKNOWN)
    matched = F.regexp_extract_all(broken, F.lit(_pattern()), F.lit(1))
    return cut.select(
        *[F.col(f"`{c}`") for c in rest.columns],
        F.size(own).alias("n_sentences"),
        F.size(listed).alias("n_known"),
        F.array_join(F.transform(listed, lambda c: F.try_element_at(names, c)), " ").alias("sentences"),
        F.array_join(F.transform(matched, lambda m: F.try_element_at(licences, m)), " ").alias("licences"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _sql_map(pairs) -> str:
    pairs = list(pairs)
    return f"MAP([{', '.join(_quoted(k) for k, _ in pairs)}], [{', '.join(_quoted(v) for _, v in pairs)}])"


def _sql_steps(text: str, steps: list[tuple[str, str]]) -> str:
    """Nested regular replacements of DuckDB; ``$1`` of Java is ``\\1`` there."""
    for pattern, by in steps:
        shown = _quoted(by.replace("$", "\\")).replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, {_quoted(pattern)}, {shown}, 'g')"
    return text


def oracle() -> str:
    """The same rows in DuckDB's SQL. Its patterns do not look ahead or back, so three are written otherwise."""
    marks = r"[\x20\x09\x0B-\x0D!-/:-@\[-`{-~]*"
    line_marks = rf"\n{marks}(?:(?:REM|Rem|rem|dnl)(?:[\x20\x09\x0D]{marks}|(?m:$)))?"
    before = [(r"(^|[^A-Za-z0-9])([vV])[.]([\x20\x09-\x0D]+[0-9])", "$1$2$3"), (
        r"(?i)(following\s+conditions(?:\s+are\s+met)?:)[\x20\x09]+([^\x20\x09-\x0D])", "$1\n$2")]
    lines = "regexp_replace(regexp_replace(small, '[^a-z0-9\\n]+', ' ', 'g'), '\\x20?\\n\\x20?', chr(10), 'g')"
    clause, by = _unknown_clause()
    return f"""
WITH maps AS (
  SELECT {_sql_map((text, codes()[name]) for text, name in known().items())} AS known,
         {_sql_map((code, name) for name, code in codes().items())} AS names,
         {_sql_map(rules())} AS licences
), bare AS (
  SELECT doc_id, {_sql_steps("chr(10) || coalesce(text, '')", [(line_marks, chr(10))])} AS t FROM documents
), filled AS (
  SELECT doc_id, CASE WHEN regexp_matches(t, {_quoted(HINT)}) THEN {_sql_steps("t", REWRITES)} ELSE t END AS t FROM bare
), parted AS (
  SELECT doc_id, CASE WHEN contains(t, 'SPDX-License-Identifier:') AND regexp_matches(t, {_quoted(HINT)})
    THEN {_sql_steps("t", TAG_STEPS)} ELSE t END AS t FROM filled
), lowered AS (
  SELECT doc_id, translate({_sql_steps(_sql_steps("t", before), [(SENTENCE_END, chr(10) * 2)])},
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS small FROM parted
), cut AS (
  SELECT doc_id, names, licences, list_transform(
    list_transform(regexp_extract_all(trim({lines}), {_quoted(_pieces())}), lambda p: replace(p, chr(10), ' ')),
    lambda p: coalesce(known[p], CASE WHEN regexp_matches(p, '^{NUMBER}') THEN known[regexp_replace(p, '^{NUMBER}', '')] END, '{UNKNOWN}')) AS codes
  FROM lowered, maps
), listed AS (
  SELECT *, list_filter(codes, lambda c: c <> '{UNKNOWN}') AS found,
    regexp_extract_all(
      regexp_replace(regexp_replace(regexp_replace(array_to_string(codes, ''), {_quoted(clause)}, '{by}', 'g'),
        '{UNKNOWN}{{{BREAK},}}', '#', 'g'), '{UNKNOWN}', '', 'g'),
      '{_pattern()}', 1) AS matched
  FROM cut
)
SELECT doc_id, len(codes)::INTEGER AS n_sentences, len(found)::INTEGER AS n_known,
  array_to_string(list_transform(found, lambda c: names[c]), ' ') AS sentences,
  array_to_string(list_transform(matched, lambda m: licences[m]), ' ') AS licences
FROM listed
"""
