import random
import re

from cases import as_sf, edge_docs, empty_docs, words

from coderail.llm.op07_licenses import CUE, TEMPLATES, best_at, differences, notices, op7_license_scan, plain, ranked, recognise, scan, templates, words_of

LINES = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
         "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
         "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "All rights reserved.": "All-rights-reserved"}


def test_every_template_is_recognised_as_itself():
    for name, (text, _) in TEMPLATES.items():
        assert recognise(text)[:2] == (name, "exact")
        assert recognise(text + " Some other words follow here.")[:2] == (name, "exact"), name


def test_changed_and_foreign_wording():
    assert recognise("This work is licensed under the GNU General Public License, version 7.") is None
    assert recognise("A driving license was shown to the officer at the gate.") is None
    long = TEMPLATES["MIT-text"][0].replace("hereby ", "").replace("merge, ", "")
    assert recognise(long)[:5] == ("MIT-text", "modified", 2, "hereby merge", "")
    assert differences(words_of("a b d e"), words_of("a b c d")) == (["c"], ["e"])


def test_notices_behind_other_words_and_over_line_breaks():
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed."
    gpl = "/*\n * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as\n" \
          " * published by the Free Software Foundation, either version 3 of the License,\n * or (at your option) any later version.\n */"
    for text, name, verdict in (("This project is licensed under the MIT License.", "MIT", "modified"),
                                ("This project is licensed under the Apache License, Version 2.0.", "Apache-2.0", "exact"),
                                (mpl, "MPL-2.0", "exact"), ("// " + mpl.replace("\n", "\n// "), "MPL-2.0", "exact"), (gpl, "GPL-3.0-header", "exact"),
                                ("Our small tool, released\nunder the MIT\nLicense.", "MIT", "exact")):
        assert [x[:2] for x in notices("Some words. And more of them\n" + text + "\nThe rest, it is.")] == [(name, verdict)], text
    twice = "Licensed under CC BY 4.0. Licensed under CC BY 4.0. All rights reserved. Released under the MIT License."
    assert [(x.license, x.start) for x in notices(twice)] == [("CC-BY-4.0", 0), ("CC-BY-4.0", 26), ("All-rights-reserved", 52), ("MIT", 73)]
    assert notices("The MIT was founded under a license. Licensed plumber, version 2.0 of the Apache helicopter.") == []


def test_short_names_and_spdx_lines():
    said = {"SPDX-License-Identifier: MIT": "MIT", "The MIT License (MIT)": "MIT", "Released under the MIT licence": "MIT", "Licensed under the GPLv3.": "GPL-3.0",
            "Licensed under the Apache 2.0 license": "Apache-2.0", "Distributed under the BSD 3-Clause License.": "BSD-3-Clause",
            "GNU General Public License v2.0 only": "GPL-2.0", "This work is licensed under CC-BY-4.0": "CC-BY-4.0", "(licensed under MIT)": "MIT",
            "SPDX-License-Identifier: GPL-2.0-or-later": "GPL-2.0-or-later", "is LGPLv3+ code": "LGPL-3.0", "/* SPDX-License-Identifier: Apache-2.0 */": "Apache-2.0",
            "under Creative Commons Attribution-ShareAlike 4.0 terms": "CC-BY-SA-4.0", "in the MPL 2.0 sense": "MPL-2.0"}
    for text, name in said.items():
        for whole in (text, "Some words, and a line.\n" + text + "\nMore words."):
            assert [x.license for x in notices(whole)] == [name], whole
    assert notices("A license from the agency. The Apache helicopter, version 2.0. All the rights of the public. CC the general on version 3.") == []


def test_templates_are_ranked_by_the_bytes_that_they_save():
    block = tuple(words_of("Some words. This work is licensed under the GNU Lesser General Public License, version 3. More of them"))
    raw, order = " ".join(block).encode(), ranked(block, 16)
    saved = [len(plain().compress(raw)) - len(templates()[16][k].compressor.compress(raw)) for _, k, _ in order]
    assert saved == sorted(saved, reverse=True) and saved == [-less for less, _, _ in order] and len(order) > 2
    assert templates()[16][order[0][1]].name == "LGPL-3.0"


def test_every_notice_that_brute_force_confirms_is_confirmed():
    """Every run of words over every cue against every template: a notice is found at a cue just where one of them is confirmed."""
    def by_hand(text, at):
        words, before = words_of(text), len(words_of(text[:at]))
        for template in (t for group in templates().values() for t in group):
            if template.telling <= set(words):
                for a in range(before + 1):
                    for b in range(max(before, a + len(template.words) - template.most - 1), min(len(words), a + len(template.words) + template.most)):
                        missing, added = differences(words[a : b + 1], template.words)
                        if max(len(missing), len(added)) <= template.most and not template.telling & set(missing):
                            return True
        return False

    rng, short, found = random.Random(8), [t for t, _ in TEMPLATES.values() if len(t.split()) < 20], 0
    for _ in range(150):
        changed = rng.choice(short).split()
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(changed))
            changed[i : i + 1] = rng.choice([[], [changed[i], "zz"], ["qq"], [changed[i], changed[i]]])
            changed = changed or ["license"]
        text = words(rng, rng.randint(0, 6)) + " " + " ".join(changed) + " " + words(rng, rng.randint(0, 6))
        for m in re.finditer(CUE, text, re.IGNORECASE):
            at = m.start()
            while at and not text[at - 1].isspace():
                at -= 1
            assert (best_at(text, m.start()) is not None) == by_hand(text, at), text
            found += best_at(text, m.start()) is not None
    assert found > 50


def test_notices_in_documents(spark):
    rng = random.Random(4)
    rows = []
    for i, line in enumerate(LINES):
        rows += [(10 * i, words(rng, 50) + ".\n" + line + "\n" + words(rng, 50)), (10 * i + 1, words(rng, 30) + ". " + line + " " + words(rng, 30)), (10 * i + 2, line)]
    rows += [(900, words(rng, 300)), (901, "licensed " + words(rng, 20)), (902, None), (903, ""), (None, "Released under the MIT License.")]
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["license"], r["verdict"]) for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    want = [(10 * i + k, name, "exact") for i, name in enumerate(LINES.values()) for k in range(3)] + [(-1, "MIT", "exact")]
    assert got == sorted(want)


def test_every_notice_of_the_test_table_is_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = sorted((r["doc_id"], name) for r in docs.collect() for line, name in LINES.items() for x in (r["text"] or "").split("\n") if x == line)
    got = sorted((r["doc_id"], r["license"]) for r in scan(docs).where("verdict = 'exact'").collect())
    assert got == want and len(want) > 10


def test_edge_and_empty_documents(spark, tmp_path):
    assert op7_license_scan(spark, as_sf(spark, edge_docs(spark), tmp_path / "a")).count() == 0
    assert op7_license_scan(spark, as_sf(spark, empty_docs(spark), tmp_path / "b")).count() == 0


def test_ids_stay_exact_beside_a_null(spark):
    text = TEMPLATES["MIT"][0]
    rows = [((1 << 53) + 1 + 2 * i, text) for i in range(4)] + [(None, text)]
    got = scan(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert sorted(r["doc_id"] for r in got if r["doc_id"] is not None) == [i for i, _ in rows[:-1]] and len(got) == 5
