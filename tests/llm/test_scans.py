import hashlib
import pathlib
import random
import re
import secrets as random_secrets
from collections import Counter

import duckdb
import pytest
import zstandard
from pyspark.sql import functions as F

from martloom.llm import quality_rules, secret_scan
from martloom.llm.oracles import license_sql
from martloom.llm.license_scan import ENDS, HINT, RULES, SENTENCES, scan_licenses
from tests.llm.odd import COLUMNS, ROWS, no_documents, odd_documents, prose, table

KEYWORD = "|".join(
    "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)
    for word in ("password", "passwd", "secret", "token", "api_?key")
)
ASSIGN = re.compile(rf"""({KEYWORD})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base_by_hand(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(found))


def secret_texts():
    draw, out = random.Random(4), [t or "" for _, t in ROWS]
    bits = ["password", "Secret", "API_key", "apikey", "token", "=", ": ", " = ", '"', "'", "é😀", " "]
    bits += ["AKIA", "AKIA" + "Z9" * 6, "AKIAAKIA", "0123456789abcdef" * 2, "deadbeef", "abc", "x.y-z/1="]
    bits += ["\n", "secret=token=abcdefgh", "token=abc: abcdefghij", "0123456789abcdef" * 3 + "A"]
    for _ in range(400):
        out.append("".join(draw.choices(bits, k=draw.randrange(12))))
    return out


def test_base_spans_by_hand(spark):
    texts = secret_texts()
    found = secret_scan.scan_secrets(table(spark, list(enumerate(texts)))).collect()
    for row in found:
        want = base_by_hand(texts[row.doc_id])
        assert row.base_sha256 == hashlib.sha256(want.encode()).hexdigest(), texts[row.doc_id]
        kinds = Counter(x.split(":")[0] for x in want.split(",") if x)
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(kinds[k] for k in secret_scan.KINDS[:3])
        kept = [x for x in row.spans.split(",") if not x.startswith("random")]
        assert ",".join(kept) == want


def test_battery_finds_random_tokens_and_leaves_words(spark):
    draw, words = random.Random(8), "abcdefghijklmnopqrstuvwxyz"
    alphabet = secret_scan.ALPHABETS[-1][1]
    keys = ["".join(draw.choices(alphabet, k=64)) for _ in range(60)]
    rows = [(i, f"{prose(i, 30)} {key} end") for i, key in enumerate(keys)]
    slow = ["-".join("".join(draw.choices("etaoinshr", k=5)) for _ in range(9)) for _ in range(60)]
    slow += ["=" * 60, "abab" * 20, "a" * 70, words * 3, "0123456789" * 7]
    rows += [(1000 + i, f"see /{name}/ here") for i, name in enumerate(slow)]
    found = {r.doc_id: r.spans for r in secret_scan.scan_secrets(table(spark, rows)).collect()}
    caught = sum("random" in found[i] for i in range(60))
    false = sum("random" in found[i] for i in found if i >= 1000)
    assert caught >= 55 and false <= 3
    start = rows[0][1].index(keys[0])
    assert found[0] in ("", f"random:{start}:{start + 64}")


def test_chance_is_the_normal_tail(spark):
    from statistics import NormalDist

    z = [-7.5, -5.0, -3.2, -1.0, 0.0, 0.7, 2.5]
    found = spark.createDataFrame([(x,) for x in z], "z double").select("z", secret_scan.chance(F.col("z")))
    for at, p in found.collect():
        assert p == pytest.approx(NormalDist().cdf(at), rel=1e-6)


def test_redaction_keeps_the_rest(spark):
    key = "password = hunter2hunter2"
    rows = [(1, f"é {key} and {key} end"), (2, "clean"), (3, None), (4, ""), (5, key)]
    clean = secret_scan.redact_documents(odd_documents(spark, rows))
    assert clean.columns == COLUMNS
    got = {r.doc_id: r.text for r in clean.collect()}
    assert got == {1: "é [secret] and [secret] end", 2: "clean", 3: None, 4: "", 5: "[secret]"}


def test_scans_of_no_documents(spark):
    none = no_documents(spark)
    assert secret_scan.scan_secrets(none).count() == 0
    assert secret_scan.redact_documents(none).count() == 0
    assert scan_licenses(none).count() == 0
    assert quality_rules.judge_documents(none).count() == 0


def test_known_sentences_pass_their_own_hint():
    for name, words in SENTENCES.items():
        assert re.search(HINT, words), name
        assert re.fullmatch("[a-z0-9]+( [a-z0-9]+)*", words), name
    used = {name for _, _, needs in RULES for name in needs}
    assert used <= set(SENTENCES)


def test_licenses(spark):
    header = (
        'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file '
        "except in compliance\nwith the License. You may obtain a copy of the License at\n\n http://x\n\n"
    )
    rows = [
        (1, "some words\nReleased under the MIT License.\nmore"),
        (2, header),
        (3, "Licensed under CC BY-NC 4.0. All rights reserved."),
        (4, "the MIT License is mentioned only"),
        (5, None),
        (6, ""),
        (None, "LICENSED UNDER THE APACHE LICENSE, VERSION 2.0."),
        (7, "Licensed under the\nApache License, Version 2.0!"),
        (8, "released under the mit license"),
        (8, "released under the mit license"),
    ]
    found = Counter((r.doc_id, r.licenses) for r in scan_licenses(odd_documents(spark, rows)).collect())
    assert found == Counter(
        {
            (1, "MIT:release"): 1,
            (2, "Apache-2.0:short-header"): 1,
            (3, "CC-BY-NC-4.0:reference,Proprietary:reserved"): 1,
            (4, ""): 1,
            (5, ""): 1,
            (6, ""): 1,
            (None, "Apache-2.0:reference"): 1,
            (7, "Apache-2.0:reference"): 1,
            (8, "MIT:release"): 2,
        }
    )
    assert ENDS


def counts_by_hand(text):
    words = re.findall("[^\x20\x09-\x0d]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {
        i + j for i in range(len(words) - 2) for j in range(3) if windows[tuple(words[i : i + 3])] > 1
    }
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(inside))


def test_rule_counts_by_hand(spark):
    draw = random.Random(3)
    texts = [t or "" for _, t in ROWS]
    for _ in range(200):
        pool = ["a", "b", "c", "Ünï", "#", "x|y", "\n", "\r\n", "\x0b", "\x1c", "\xa0", "word", "same line\n"]
        texts.append(" ".join(draw.choices(pool, k=draw.randrange(90))))
    rows = quality_rules.judge_documents(table(spark, list(enumerate(texts)))).collect()
    for r in rows:
        want = counts_by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)
    odd = quality_rules.judge_documents(odd_documents(spark)).collect()
    assert len(odd) == len(ROWS)


def test_numbers_of_many_distinct_words_do_not_overflow():
    words = [b"%d" % i for i in range(1 << 20)] + [b"a", b"b", b"c", b"d", b"a", b"b", b"c"]
    assert quality_rules.repeated_words(words) == 6


def test_bands_reject_what_repeats_and_what_does_not_shrink():
    bands, draw = quality_rules.Bands(), random.Random(5)
    english = " ".join(prose(i, 100) for i in range(30))
    cycle = (PARAGRAPH * 40)[:20_000]
    noise = random_secrets.token_bytes(9_000).hex().encode()
    noise = bytes(draw.choices(range(33, 127), k=9_000)) or noise
    assert not bands.accept(cycle.encode())
    assert not bands.accept(noise)
    assert bands.accept(PARAGRAPH.encode()) and bands.accept(b"")
    data = PARAGRAPH.encode()
    assert bands.ratio(data) == pytest.approx(
        len(data) / len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
    )
    assert english


PARAGRAPH = (
    "When the ferry left the harbour that morning, nobody on deck paid much attention to the grey "
    "line of weather lying along the western horizon. The crew had seen a hundred such mornings, "
    "and the passengers, most of whom were travelling to the island for its autumn market, were "
    "busy with their baskets, their children and their gossip. Only the old pilot, who had sailed "
    "these waters since before the lighthouse was built, kept turning his head to look. By noon the "
    "swell had lengthened, gulls were flying inland, and he asked quietly for the hatches to be "
    "closed. Later, people would say that his small request had saved them all. "
)


def test_bands_accept_other_scripts_and_long_formal_prose():
    """Prose of two and three bytes a letter, of two lengths, and a licence of 17 KB."""
    bands, cyrillic, kana = quality_rules.Bands(), {}, {}
    for i, c in enumerate("abcdefghijklmnopqrstuvwxyz"):
        cyrillic |= {ord(c): 0x430 + i, ord(c.upper()): 0x410 + i}
        kana |= {ord(c): 0x3042 + 2 * i, ord(c.upper()): 0x3042 + 2 * i}
    draw = random.Random(6)
    words = ["".join(draw.choices("etaoinshrdlucmfwyp", k=draw.randrange(2, 11))) for _ in range(900)]
    weights = [1 / (i + 5) for i in range(900)]
    for n in (900, 4000):
        text = " ".join(draw.choices(words, weights, k=n))
        for letters in ({}, cyrillic, kana):
            data = text.translate(letters).encode()
            assert bands.accept(data), (n, bands.ratio(data))
    cycle = " ".join(draw.choices(words, k=40) * 60).translate(cyrillic)
    assert not bands.accept(cycle.encode())


@pytest.mark.parametrize("name", ["GPL-2", "GPL-3", "LGPL-2.1", "CC0-1.0"])
def test_bands_accept_licences(name):
    """Those of the formal texts here that repeat themselves more, MPL and Apache, go."""
    file = pathlib.Path("/usr/share/common-licenses", name)
    if not file.exists():
        pytest.skip("no such text here")
    assert quality_rules.Bands().accept(file.read_bytes())


def verdict_by_hand(text):
    """The bands once more: ratios of slices, limits found from the longest down."""
    def beyond(data, bands):
        packed = len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
        start, least, most = max(band for band in bands if band[0] <= len(data))
        points = sum(1 for byte in data if byte & 0xC0 != 0x80)
        return [len(data) / packed < least, points / packed > most]

    data = text.encode()
    if not data:
        return True
    pieces = [data[i : i + 4096] for i in range(0, len(data), 4096)]
    if len(pieces) > 1 and len(pieces[-1]) < 2048:
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    if len(data) < 2048:
        pieces = []
    found = [beyond(piece, quality_rules.CHUNK_BANDS) for piece in pieces]
    dense, repeated = (sum(f[i] for f in found) for i in range(2))
    return not any(beyond(data, quality_rules.TEXT_BANDS)) and (
        4 * dense <= len(pieces) and 2 * repeated <= len(pieces)
    )


def test_verdict_by_hand_and_by_label(spark):
    """Over whole tables: the verdict equals a second version of it, and follows the labels."""
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    quality = {
        r.doc_id: r.quality
        for r in spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", "quality").collect()
    }
    long = {0: [], 1: []}
    for r in quality_rules.judge_documents(docs).collect():
        text = texts[r.doc_id]
        assert r.kept == (not r.base_failed and verdict_by_hand(text))
        if not r.base_failed and len(text.encode()) >= 2048 and r.doc_id in quality:
            long[quality[r.doc_id]].append(r.kept)
    assert long[0] and long[1]
    assert sum(long[0]) <= len(long[0]) / 2
    assert sum(long[1]) >= 0.99 * len(long[1])


def test_notices_of_further_licences(spark):
    gnu = (
        "This program is free software{} you can redistribute it and/or modify\nit under the terms "
        "of the GNU {}General Public License as published by\nthe Free Software Foundation{} either "
        "version {} of the License, or\n(at your option) any later version.\n"
    )
    rows = {
        "GPL-2.0:notice": gnu.format(";", "", ";", 2),
        "GPL-3.0:notice": gnu.format(":", "", ",", 3),
        "LGPL-2.1:notice": gnu.format(";", "Lesser ", ";", "2.1"),
        "AGPL-3.0:notice": gnu.format(":", "Affero ", ",", 3),
        "MPL-2.0:notice": "This Source Code Form is subject to the terms of the Mozilla Public\n"
        "License, v. 2.0. If a copy of the MPL was not distributed",
        "ISC:text": "Permission to use, copy, modify, and/or distribute this software for any\npurpose "
        "with or without fee is hereby granted, provided that the above\ncopyright notice and this "
        "permission notice appear in all copies.",
        "Unlicense:text": "This is free and unencumbered software released into the public domain.",
        "MIT:project": "This project is licensed under the MIT License.",
    }
    docs = odd_documents(spark, list(enumerate(rows.values())))
    found = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(rows))] == list(rows)


def test_tags_and_other_subjects(spark):
    rows = {
        "# SPDX-License-Identifier: MIT\nimport os": "MIT:spdx",
        "// spdx-license-identifier:\tApache-2.0\n": "Apache-2.0:spdx",
        "/* SPDX-License-Identifier: GPL-2.0-or-later */": "GPL-2.0:spdx-or-later",
        "SPDX-License-Identifier: LGPL-2.1-only": "LGPL-2.1:spdx-only",
        "SPDX-License-Identifier: BSD-3-Clause": "BSD-3-Clause:spdx",
        "SPDX-License-Identifier: WTFPL": "",
        "SPDX-License-Identifier:": "",
        "The package is licensed under the MIT License.": "MIT:reference",
        "Foo is licensed under the Apache License, Version 2.0.": "Apache-2.0:reference",
        "All of our examples are released under CC BY 4.0.": "CC-BY-4.0:reference",
        "This project is licensed under the MIT License.": "MIT:project",
        "If it is licensed under the MIT License, say so.": "",
        "Nothing is licensed under the MIT License.": "",
        "It is not licensed under the MIT License.": "",
    }
    docs = odd_documents(spark, list(enumerate(rows)))
    found = {r.doc_id: r.licenses for r in scan_licenses(docs).collect()}
    assert [found[i] for i in range(len(rows))] == list(rows.values())


def test_sql_counterpart_on_notices(spark, tmp_path):
    """The SQL gives the same on notices, tags and sentences that no test table holds."""
    subjects = ["", "This work is ", "Foo is ", "If foo is ", "the five small words here are "]
    verbs = ["licensed under ", "released under ", "available under "]
    ends = ["the MIT License.", "CC BY 4.0", "the Apache License, Version 2.0; more", "CC0 1.0 Universal."]
    texts = [f"Some words.\n{a}{b}{c}\n" for a in subjects for b in verbs for c in ends]
    texts += [f"SPDX-License-Identifier: {x}\ny" for x in ("MIT", "GPL-3.0+", "ISC OR MIT", "CC0-1.0")]
    docs = table(spark, list(enumerate([*texts, None, ""])))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.execute(license_sql()).fetchall()
    got = [tuple(r) for r in scan_licenses(docs).collect()]
    assert sorted(got) == sorted(want)
    assert len({r[3] for r in got}) > 8


def gnu_notice(kind, version):
    return (
        f"This is free software; you can redistribute it and/or modify it under the terms of the "
        f"GNU {kind}General Public License as published by the Free Software Foundation; either "
        f"version {version} of the License, or (at your option) any later version.\n\n"
    )


def test_a_version_belongs_to_the_grant_before_it(spark):
    """Notices after one another give their own licences and no others."""
    kinds = {"GPL": "", "LGPL": "Lesser ", "AGPL": "Affero "}
    known = {("GPL", "2"), ("GPL", "3"), ("LGPL", "2.1"), ("LGPL", "3"), ("AGPL", "3")}
    pairs = [(a, b) for a in sorted(known) for b in sorted(known) if a != b]
    rows = [(n, "".join(gnu_notice(kinds[k], v) for k, v in pair)) for n, pair in enumerate(pairs)]
    found = {r.doc_id: r.licenses for r in scan_licenses(odd_documents(spark, rows)).collect()}
    for n, pair in enumerate(pairs):
        names = {x.partition(":")[0] for x in found[n].split(",")}
        assert names == {f"{k}-{v if '.' in v else v + '.0'}" for k, v in pair}, pair
