"""License scans with ordered signature rules, in DataFrame functions only.

Texts are reduced to lower-case words with one blank between them, and rules are regular expressions over whole words. A
rule is tried only where its keyword stands in the text, and texts without any of a few parts of words that all keywords
share are not reduced at all. What rules find are intervals of words. An interval inside another one of a rule with
the same or a higher priority is suppressed; of equal intervals the first rule's stays.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Priorities: a stated identifier or address, a license named with a phrase around it, a name alone.
STATED, NAMED, BARE = 3, 2, 1
WEIGHTS = {STATED: 1.0, NAMED: 0.9, BARE: 0.6}


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: str
    base: bool = False


# The phrases and labels that are always reported.
BASE = (
    ("gpl", "gnu", "gnu general public license"),
    ("apache", "apache", "apache license"),
    ("cc-by", "cc", "cc by"),
    ("mit", "mit", "mit license"),
)

# Label, keyword, how the license is named in words, identifier and address in words ("2.0" is "2 0").
LICENSES = (
    ("apache-1.1", "apache", r"apache(?: software)? licen[sc]e(?: version)? v?1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-2.0", "apache", r"apache(?: software)? licen[sc]e(?: version)? v?2(?: 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("mit", "mit", r"mit(?: x11| expat)? licen[sc]e", "mit", "opensource org licenses? mit"),
    ("mit", "expat", r"expat licen[sc]e", "expat", "directory fsf org wiki license expat"),
    ("mit-0", "mit", r"mit no attribution(?: licen[sc]e)?", "mit 0", "opensource org licenses? mit 0"),
    ("x11", "x11", r"x11 licen[sc]e", "x11", "xfree86 org 3 3 6 copyright2"),
    ("gpl-1.0", "gnu", r"gnu general public licen[sc]e(?: gpl)?(?: as published by the free software foundation either)? v(?:ersion )?1(?: 0)?", "gpl 1 0(?: only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2.0", "gnu", r"gnu general public licen[sc]e(?: gpl)?(?: as published by the free software foundation either)? v(?:ersion )?2(?: 0)?", "gpl 2 0(?: only| or later)?", "gnu org licenses (?:old licenses )?gpl 2 0"),
    ("gpl-3.0", "gnu", r"gnu general public licen[sc]e(?: gpl)?(?: as published by the free software foundation either)? v(?:ersion )?3(?: 0)?", "gpl 3 0(?: only| or later)?", "gnu org licenses gpl 3 0"),
    ("lgpl-2.0", "gnu", r"gnu (?:library|lesser) general public licen[sc]e(?: lgpl)? v(?:ersion )?2(?: 0)?", "lgpl 2 0(?: only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "gnu", r"gnu lesser general public licen[sc]e(?: lgpl)? v(?:ersion )?2 1", "lgpl 2 1(?: only| or later)?", "gnu org licenses (?:old licenses )?lgpl 2 1"),
    ("lgpl-3.0", "gnu", r"gnu lesser general public licen[sc]e(?: lgpl)? v(?:ersion )?3(?: 0)?", "lgpl 3 0(?: only| or later)?", "gnu org licenses lgpl 3 0"),
    ("lgpl", "gnu", r"gnu (?:library|lesser) general public licen[sc]e", "lgpl", "gnu org licenses lgpl"),
    ("agpl-3.0", "gnu", r"gnu affero general public licen[sc]e(?: v(?:ersion )?3(?: 0)?)?", "agpl 3 0(?: only| or later)?", "gnu org licenses agpl 3 0"),
    ("gfdl-1.2", "gnu", r"gnu free documentation licen[sc]e v(?:ersion )?1 2", "gfdl 1 2(?: only| or later)?", "gnu org licenses old licenses fdl 1 2"),
    ("gfdl-1.3", "gnu", r"gnu free documentation licen[sc]e(?: v(?:ersion )?1 3)?", "gfdl 1 3(?: only| or later)?", "gnu org licenses fdl 1 3"),
    ("gpl", "gpl", r"gpl(?: licen[sc]e)?", "gpl", "gnu org copyleft gpl"),
    ("gpl-2.0", "gplv2", r"gplv2", "gplv2", "gnu org licenses gplv2"),
    ("gpl-3.0", "gplv3", r"gplv3", "gplv3", "gnu org licenses gplv3"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd licen[sc]e|bsd (?:2|two) clause(?: simplified)?(?: licen[sc]e)?|(?:2|two) clause bsd(?: licen[sc]e)?)", "bsd 2 clause", "opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:(?:new|revised|modified) bsd licen[sc]e|bsd (?:3|three) clause(?: new or revised)?(?: licen[sc]e)?|(?:3|three) clause bsd(?: licen[sc]e)?)", "bsd 3 clause", "opensource org licenses? bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd licen[sc]e|bsd (?:4|four) clause(?: licen[sc]e)?|(?:4|four) clause bsd(?: licen[sc]e)?)", "bsd 4 clause", "directory fsf org wiki license bsd 4clause"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", "bsd", "opensource org licenses bsd license"),
    ("0bsd", "0bsd", r"0bsd(?: licen[sc]e)?", "0bsd", "opensource org licenses? 0bsd"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e(?: mpl)?(?: version)? v?1 1", "mpl 1 1", "mozilla org mpl mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e(?: mpl)?(?: version)? v?2(?: 0)?", "mpl 2 0", "mozilla org mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl", "mozilla org mpl"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e(?: epl)?(?: version)? v?1(?: 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e(?: epl)?(?: version)? v?2(?: 0)?", "epl 2 0", "eclipse org legal epl (?:v20|2 0)"),
    ("cddl-1.0", "cddl", r"(?:common development and distribution licen[sc]e )?cddl(?: version)? v?1(?: 0)?", "cddl 1 0", "opensource org licenses? cddl 1 0"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: version 1 0)?", "cpl 1 0", "opensource org licenses? cpl1 0"),
    ("eupl-1.2", "eupl", r"(?:european union public licen[sc]e )?eupl(?: v(?:ersion )?1 2)?", "eupl 1 2", "joinup ec europa eu .{0,40}eupl"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e(?: version)? 1(?: 0)?", "artistic 1 0", "opensource org licenses? artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e(?: version)? 2(?: 0)?", "artistic 2 0", "opensource org licenses? artistic 2 0"),
    ("boost-1.0", "boost", r"boost software licen[sc]e(?: version 1 0)?", "bsl 1 0", "boost org license 1 0"),
    ("isc", "isc", r"isc licen[sc]e", "isc", "opensource org licenses? isc"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", "zlib net zlib license"),
    ("libpng", "libpng", r"libpng licen[sc]e", "libpng", "libpng org pub png src libpng license"),
    ("openssl", "openssl", r"openssl licen[sc]e", "openssl", "openssl org source license"),
    ("python-2.0", "python", r"python software foundation licen[sc]e(?: version 2)?", "(?:psf|python) 2 0", "docs python org 3 license"),
    ("php-3.01", "php", r"php licen[sc]e(?: version 3 01)?", "php 3 01", "php net license 3 01"),
    ("ruby", "ruby", r"ruby licen[sc]e", "ruby", "ruby lang org en license"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql", "postgresql org about licen[sc]e"),
    ("unlicense", "unlicense", r"(?:the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", r"wtfpl(?: licen[sc]e)?", "wtfpl", "wtfpl net"),
    ("ofl-1.1", "sil", r"sil open font licen[sc]e(?: version 1 1)?", "ofl 1 1", "scripts sil org ofl"),
    ("osl-3.0", "open", r"open software licen[sc]e(?: version)? 3(?: 0)?", "osl 3 0", "opensource org licenses? osl 3 0"),
    ("afl-3.0", "academic", r"academic free licen[sc]e(?: version)? 3(?: 0)?", "afl 3 0", "opensource org licenses? afl 3 0"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms pl", "opensource org licenses? ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms rl", "opensource org licenses? ms rl"),
    ("ecl-2.0", "educational", r"educational community licen[sc]e(?: version)? 2(?: 0)?", "ecl 2 0", "opensource org licenses? ecl 2 0"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e(?: v(?:ersion )?1 0)?", "upl 1 0", "oss oracle com licenses upl"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e", "ncsa", "opensource org licenses? ncsa"),
    ("vim", "vim", r"vim licen[sc]e", "vim", "vimdoc sourceforge net htmldoc uganda"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database licen[sc]e(?: odbl)?(?: v?1 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons", r"open data commons attribution licen[sc]e(?: v?1 0)?", "odc by 1 0", "opendatacommons org licenses by"),
    ("pddl-1.0", "pddl", r"pddl(?: v?1 0)?", "pddl 1 0", "opendatacommons org licenses pddl"),
    ("sspl-1.0", "server", r"server side public licen[sc]e(?: v(?:ersion )?1)?", "sspl 1 0", "mongodb com licensing server side public license"),
    ("busl-1.1", "business", r"business source licen[sc]e(?: version)?(?: 1 1)?", "busl 1 1", "mariadb com bsl11"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: version)?(?: v?2 0)?", "elastic 2 0", "elastic co licensing elastic license"),
)

#: Parts of Creative Commons licenses, the versions they exist in, and their names.
CC_KINDS = (
    ("by", "attribution"),
    ("by sa", "attribution share ?alike"),
    ("by nc", "attribution non ?commercial"),
    ("by nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by nc sa", "attribution non ?commercial share ?alike"),
    ("by nc nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

# Notices that are not licenses by name. Label, keyword, pattern.
NOTICES = (
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    ("public-domain", "domain", r"(?:released|placed|dedicated|is|in)(?: in)?(?: to)? the public domain"),
    ("all-rights-reserved", "reserved", r"all rights reserved"),
    ("all-rights-reserved", "vorbehalten", r"alle rechte vorbehalten"),
    ("all-rights-reserved", "droits", r"tous droits r(?:e|é)serv(?:e|é)s"),
    ("all-rights-reserved", "derechos", r"todos los derechos reservados"),
    ("copyright-notice", "copyright", r"copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?"),
    ("proprietary", "licensed", r"licensed under a commercial licen[sc]e"),
    ("proprietary", "proprietary", r"proprietary licen[sc]e"),
    ("proprietary", "agreement", r"licen[sc]e agreement"),
    ("proprietary", "user", r"end user licen[sc]e"),
    ("creative-commons", "creative", r"creative commons licen[sc]e"),
    ("mit", "copyright", r"the above copyright notice and this permission notice shall be included"),
    ("bsd", "copyright", r"redistributions of source code must retain the above copyright notice"),
    ("gpl", "gnu", r"terms of the gnu general public licen[sc]e as published by the free software foundation"),
    ("apache-2.0", "license", r"you may not use this file except in compliance with the license"),
)

#: What matches a rule holds one of these, as it stands in lower case; texts without them are not looked at further.
PARTS = (
    "licen", "copyright", "spdx", "gpl", "cc0", r"cc[\x00-\x2f\x3a-\x60\x7b-\x7f]+by", "wtfpl", "0bsd", "bsd", "cddl", "eupl", "pddl",
    r"public[\x00-\x2f\x3a-\x60\x7b-\x7f]+domain", "reserved", "vorbehalten", "droits", "derechos", "attribution",
    "creativecommons", "xfree86", "mozilla", "eclipse", "bsl11", "uganda", "scripts",
)


def rules() -> list[Rule]:
    """All rules, the most telling first. Names give three forms each: with a phrase, with an identifier, alone; and an address."""
    out = []
    before = r"(?:licen[sc]ed|released|distributed|provided|available|published|covered)(?: to you)? (?:under|by)(?: the)?(?: terms(?: and conditions)? of)?(?: the)? "
    creative = []
    for short, name in CC_KINDS:
        for version in CC_VERSIONS:
            label = f"cc-{short.replace(' ', '-')}-{version.replace(' ', '.')}"
            number = version.removesuffix(" 0")
            spelled = rf"creative commons {name}(?: {number}| {version})(?: (?:international|unported|generic))?(?: public)?(?: licen[sc]e)?"
            creative.append((label, "cc", rf"cc {short}(?: v)? {version}", f"cc {short} {version}", f"creativecommons org licenses {short} {version}"))
            creative.append((label, "creative", spelled, None, None))
        creative.append((f"cc-{short.replace(' ', '-')}", "cc", f"cc {short}", f"cc {short}", f"creativecommons org licenses {short}"))
    everything = [*LICENSES, *creative]
    for label, _, _, identifier, _ in everything:
        if identifier:
            out.append(Rule(label, STATED, "spdx", rf"spdx licen[sc]e identifier {identifier}"))
    for label, _, _, _, address in everything:
        if address:
            out.append(Rule(label, STATED, address.split()[0], address))
    for label, keyword, name, _, _ in everything:
        out.append(Rule(label, NAMED, keyword, rf"{before}(?:a )?{name}(?: licen[sc]e)?"))
    for label, keyword, name, _, _ in everything:
        out.append(Rule(label, BARE, keyword, name))
    out += [Rule(label, BARE, keyword, pattern) for label, keyword, pattern in NOTICES]
    return [*out, *(Rule(label, BARE, keyword, pattern, base=True) for label, keyword, pattern in BASE)]


# What is no word once A-Z is lower case, and what is no word as the text stands.
_GAPS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DETECTION = "first bigint, minus_end bigint, number int, priority int, label string, base boolean"


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.transform(F.array(value), body)[0]


def _blanks(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _matches(text: Column, rule: Column) -> Column:
    """Where a rule matches: structs like ``DETECTION``. A match takes the blank before it, so blanks count words."""

    def step(matches: Column, between: Column):
        def merge(state: Column, i: Column) -> Column:
            first = state["at"] + _blanks(F.get(between, i))
            return _let(
                F.struct(first.alias("first"), (first + _blanks(F.get(matches, i))).alias("end")),
                lambda x: F.struct(
                    x["end"].alias("at"),
                    F.array_append(
                        state["out"],
                        F.struct(
                            x["first"].alias("first"), (-x["end"]).alias("minus_end"), rule["number"].alias("number"),
                            rule["priority"].alias("priority"), rule["label"].alias("label"), rule["base"].alias("base"),
                        ),
                    ).alias("out"),
                ),
            )

        return merge

    none = F.array().cast(f"array<struct<{DETECTION.replace(' ', ':').replace(',:', ',')}>>")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out"))
    found = F.regexp_extract_all(text, rule["pattern"], F.lit(0))
    return _let(
        found,
        lambda m: F.when(F.size(m) == 0, none).otherwise(
            _let(
                F.split(text, rule["pattern"], -1),
                lambda s: F.aggregate(F.sequence(F.lit(0), F.size(m) - 1), start, step(m, s), lambda x: x["out"]),
            )
        ),
    )


def _kept(detections: Column) -> Column:
    """Detections that are not suppressed, from all of a text in order of first word, then length, then rule."""
    reach = [F.lit(-1).cast("bigint").alias(f"to{p}") for p in (BARE, NAMED, STATED)]
    none = F.array().cast(f"array<struct<{DETECTION.replace(' ', ':').replace(',:', ',')}>>")

    def merge(state: Column, d: Column) -> Column:
        end = -d["minus_end"]
        covered = F.greatest(
            state[f"to{STATED}"],
            F.when(d["priority"] <= NAMED, state[f"to{NAMED}"]).otherwise(F.lit(-1)),
            F.when(d["priority"] <= BARE, state[f"to{BARE}"]).otherwise(F.lit(-1)),
        )
        tos = [
            F.when(d["priority"] == p, F.greatest(state[f"to{p}"], end)).otherwise(state[f"to{p}"]).alias(f"to{p}")
            for p in (BARE, NAMED, STATED)
        ]
        return F.struct(*tos, F.when(covered >= end, state["out"]).otherwise(F.array_append(state["out"], d)).alias("out"))

    return F.aggregate(detections, F.struct(*reach, none.alias("out")), merge, lambda x: x["out"])


def detect(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", table: list[Rule] | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, ``found`` (all detections) and ``kept`` (those not suppressed).

    A detection has its first word, minus the word after its last, the number of its rule, its priority and
    label, and whether it is a base phrase. A null text is empty. Rows that repeat are scanned each; other columns of
    ``docs`` are not read. Nothing is shuffled.
    """
    table = rules() if table is None else table
    literal = F.array(
        *(
            F.struct(
                F.lit(i).alias("number"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(r.base).alias("base"),
                F.lit(r.keyword).alias("keyword"), F.lit(f" (?:{r.pattern})(?= )").alias("pattern"),
            )
            for i, r in enumerate(table)
        )
    )
    keywords = F.array(*(F.lit(k) for k in sorted({r.keyword for r in table})))
    rows = docs.select(F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    gate = F.lower("text").rlike("|".join(PARTS))
    reduced = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.translate("text", _UPPER, _LOWER), _GAPS, " ")), F.lit(" "))
    rows = rows.select("doc_id", F.regexp_count("text", F.lit(_WORDS)).cast("bigint").alias("n_words"), F.when(gate, reduced).alias("words"))
    present = F.filter(keywords, lambda k: F.contains(F.col("words"), F.concat(F.lit(" "), k, F.lit(" "))))
    tried = _let(present, lambda p: F.filter(literal, lambda r: F.array_contains(p, r["keyword"])))
    found = F.array_sort(F.flatten(F.transform(tried, lambda r: _matches(F.col("words"), r))))
    none = F.array().cast(f"array<struct<{DETECTION.replace(' ', ':').replace(',:', ',')}>>")
    rows = rows.select("doc_id", "n_words", F.when(F.col("words").isNotNull(), found).otherwise(none).alias("found"))
    return rows.select("doc_id", "n_words", "found", F.when(F.size("found") > 0, _kept(F.col("found"))).otherwise(none).alias("kept"))


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, places and labels of base phrases, all labels, score.

    All base phrases count and keep their labels, also those inside other detections. The score is that of the
    highest priority met, 0 without a detection. Label columns are empty, word columns null, if there is none.
    """
    found = detect(docs, id_column, text_column)
    base = F.filter("found", lambda d: d["base"])
    labels = F.concat(F.transform(base, lambda d: d["label"]), F.transform("kept", lambda d: d["label"]))
    firsts = F.transform(base, lambda d: d["first"])
    best = F.array_max(F.transform("kept", lambda d: d["priority"]))
    score = F.coalesce(F.create_map(*(F.lit(x) for pair in WEIGHTS.items() for x in pair))[best], F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"),
        F.array_max(firsts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(base, lambda d: d["label"]))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        score.alias("score"),
    )
