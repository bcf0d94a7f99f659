from __future__ import annotations

import random
import re

from helpers import documents, odd_rows, prose
from strataflow.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def base(text):
    words = WORD.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def kept_by_pairs(text):
    """What is kept, comparing all detections with all: for the test only."""
    words = " " + " ".join(WORD.findall(text.translate({i: i + 32 for i in range(65, 91)}))) + " "
    found = []
    for number, rule in enumerate(licenses.rules()):
        if f" {rule.keyword} " not in words:
            continue
        for m in re.finditer(f" (?:{rule.pattern})(?= )", words):
            first = words[: m.start()].count(" ")
            found.append((first, first + m.group().count(" "), number, rule.priority, rule.label))
    out = set()
    for d in found:
        if not any(
            e != d and e[0] <= d[0] and e[1] >= d[1] and e[3] >= d[3] and ((e[0], e[1]) != (d[0], d[1]) or e[3] > d[3] or e[2] < d[2])
            for e in found
        ):
            out.add(d)
    return out


def texts():
    rng = random.Random(9)
    parts = [
        "Licensed under the Apache License, Version 2.0.", "MIT License", "mit-license", "GNU General Public License, version 3", "CC BY-NC 4.0",
        "cc by", "SPDX-License-Identifier: GPL-2.0-or-later", "https://www.gnu.org/licenses/gpl-3.0.html", "All rights reserved.", "Copyright (c) 2020",
        "GNU Lesser General Public License v2.1", "the three clause BSD license", "ſpdx KIT mıt licenſe", "Mozilla Public License 2.0",
        "released under the MIT License", "Creative Commons Attribution-ShareAlike 4.0 International", "emit licensed", "mit license1",
    ]
    return [" ".join(rng.choice([prose(rng, 3), rng.choice(parts), rng.choice(parts)]) for _ in range(rng.randint(1, 7))) for _ in range(150)]


def test_base_and_labels(spark):
    rows = odd_rows() + [(1000 + i, t, None, None) for i, t in enumerate(texts())]
    found = licenses.license_scan(documents(spark, rows)).collect()
    got = sorted((tuple(r[c] for c in ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")) for r in found), key=repr)
    assert got == sorted(((r[0], *base(r[1])) for r in rows), key=repr)
    assert sum(r["n_base"] for r in found) > 100
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in found)


def test_what_is_kept_against_all_pairs(spark):
    rows = [(i, t, None, None) for i, t in enumerate(texts())]
    found = {r["doc_id"]: r["kept"] for r in licenses.detect(documents(spark, rows)).collect()}
    table = licenses.rules()
    for i, text, *_ in rows:
        got = {(d["first"], -d["minus_end"], d["label"]) for d in found[i]}
        wanted = {(a, b, label) for a, b, number, _, label in kept_by_pairs(text)}
        assert got == wanted, text
    assert len(table) > 300


def test_the_gate_lets_every_rule_through(spark):
    """A sentence for each name and notice finds its label."""
    samples = {
        "apache-2.0": "under the Apache License 2.0", "gpl-3.0": "GPLv3", "lgpl-2.1": "GNU Lesser General Public License v2.1", "0bsd": "0BSD",
        "cc0-1.0": "CC0 1.0 Universal", "public-domain": "released into-the public domain is in the public domain", "wtfpl": "WTFPL", "cddl-1.0": "CDDL 1.0",
        "mpl-2.0": "see mozilla.org/MPL/2.0", "epl-1.0": "http://www.eclipse.org/legal/epl-v10", "ofl-1.1": "scripts.sil.org/OFL", "bsd-2-clause": "bsd 2-clause",
        "cc-by-sa-4.0": "Creative Commons Attribution ShareAlike 4.0", "all-rights-reserved": "tous droits réservés", "unlicense": "the Unlicense",
    }
    rows = [(i, t, None, None) for i, t in enumerate(samples.values())]
    found = {r["doc_id"]: r["labels"].split(",") for r in licenses.license_scan(documents(spark, rows)).collect()}
    assert all(label in found[i] for i, label in enumerate(samples)), found


def test_nothing_is_shuffled_and_no_python(spark):
    from contextlib import redirect_stdout
    from io import StringIO

    out = StringIO()
    with redirect_stdout(out):
        licenses.license_scan(documents(spark).select("doc_id", "text")).explain()
    assert "Exchange" not in out.getvalue() and "Python" not in out.getvalue() and "InArrow" not in out.getvalue()
