"""Quality rules, licences, decontamination and URL filters."""

import random
from collections import Counter

import duckdb
import pytest
from loomseq.llm import licenses, url_filter
from loomseq.llm.decontaminate import clean_documents, leaks
from loomseq.llm.licenses import license_scan
from loomseq.llm.quality import judge, keep_good, quality_report, repeats
from loomseq.llm.url_filter import host_reputation, judge_urls


def brute_repeats(words, window=8):
    places = {}
    for i in range(len(words) - window + 1):
        places.setdefault(tuple(words[i : i + window]), []).append(i)
    covered = [False] * len(words)
    for at in places.values():
        if len(at) > 1:
            for i in at:
                covered[i : i + window] = [True] * window
    longest = 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            k = 0
            while j + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            longest = max(longest, k)
    return covered, longest


def test_repeats_are_those_of_all_windows_and_pairs():
    rng = random.Random(1)
    for _ in range(300):
        words = [bytes([97 + rng.randrange(rng.choice([1, 2, 3, 10]))]) for _ in range(rng.randrange(80))]
        if len(words) > 20 and rng.random() < 0.5:
            words += words[3:17] + [b"z"] + words[:12]
        covered, longest = repeats(words)
        expected, best = brute_repeats(words)
        assert covered.tolist() == expected
        if any(expected):
            assert longest == best


def brute_base(text):
    words = text.encode().split()
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    repeated = sum(brute_repeats(words)[0])
    n = len(words)
    return n, sum(len(w.decode()) for w in words), sum(text.count(c) for c in "#*$%&|<>"), dup, repeated, n < 20 or 100 * repeated > 30 * n


@pytest.mark.parametrize("text", ["", " \n", "a b\na b\n\n\na b", "é ñ # $$ x|y <b>", "one two three four five six seven eight nine\n" * 5, "w\u001cx\u00a0y " * 30, " ".join(map(str, range(100)))])
def test_base_numbers(text):
    got = judge(text)
    assert got[:6] == brute_base(text)
    assert not got[-1] or not got[5]


def test_quality_of_odd_rows(nasty, empty):
    rows = quality_report(nasty).collect()
    assert len(rows) == nasty.count()
    for r in rows:
        assert r.kept is False or not r.base_failed
    kept = keep_good(nasty)
    assert kept.columns == nasty.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "6", "6", "None"]
    assert quality_report(empty).count() == 0 and keep_good(empty).count() == 0


def test_clean_text_is_kept_and_a_long_repeat_is_not():
    rng = random.Random(2)
    words = [f"w{rng.randrange(10**6)}" for _ in range(900)]
    assert judge(" ".join(words))[-1]
    assert judge(" ".join(words + words[100:110]))[-1]
    assert not judge(" ".join(words[:400] + words[:390] + words[400:]))[-1]


LICENCE_TEXTS = [
    (1, "Some text.\nReleased under the MIT License.\nMore text."),
    (2, "LICENSED under the Apache License, Version 2.0!  Licensed under the Apache License, Version 2.0."),
    (3, "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n"),
    (4, "We never said released under the MIT license here as a whole sentence"),
    (5, "Licensed under CC BY-NC 4.0."),
    (6, "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
]


def test_licences_by_rule(spark):
    got = {(r.doc_id, r.rule, r.n_matches) for r in license_scan(spark.createDataFrame(LICENCE_TEXTS, "doc_id long, text string")).collect()}
    assert got == {(1, "mit-short", 1), (2, "apache-short", 2), (3, "mit-text", 1), (5, "cc-by-nc-short", 1)}


def test_licence_sql_agrees(spark, nasty, empty):
    import pandas as pd

    documents = pd.DataFrame(LICENCE_TEXTS, columns=["doc_id", "text"])  # noqa: F841  read by DuckDB
    rows = duckdb.sql(licenses.oracle_sql()).fetchall()
    got = [tuple(r) for r in license_scan(spark.createDataFrame(LICENCE_TEXTS, "doc_id long, text string")).collect()]
    assert sorted(rows) == sorted(got)
    assert license_scan(nasty).count() == 0 and license_scan(empty).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
GPL2 = """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.
"""
GPL2_ONLY = GPL2.replace("""General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""", """General Public License version 2 as
published by the Free Software Foundation.""")
AGPL3 = GPL3.replace("GNU General", "GNU Affero General")
LGPL2 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.

This library is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY.
"""
LGPL3 = """This library is free software: you can redistribute it and/or modify
it under the terms of the GNU Lesser General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.
"""
MPL2 = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.
"""
EPL2 = """This program and the accompanying materials are made
available under the terms of the Eclipse Public License 2.0
which is available at https://www.eclipse.org/legal/epl-2.0/
"""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled
binary, for any purpose, commercial or non-commercial, and by any
means.
"""
ZLIB = """This software is provided 'as-is', without any express or implied
warranty. In no event will the authors be held liable for any damages
arising from the use of this software.

Permission is granted to anyone to use this software for any purpose,
including commercial applications, and to alter it and redistribute it
freely, subject to the following restrictions:
"""
CC0 = """To the extent possible under law, the author(s) have dedicated all
copyright and related and neighboring rights to this software to the public
domain worldwide. This software is distributed without any warranty.
"""
VERBATIM = [
    ("apache-header", APACHE), ("gpl3-header", GPL3), ("isc-text", ISC), ("bsd-text", BSD), ("mit-text", LICENCE_TEXTS[2][1]),
    ("mit-short", "Released under the MIT License."), ("mit-short-2", "Licensed under the MIT License."),
    ("apache-short", "Licensed under the Apache License, Version 2.0."), ("gpl3-short", "This work is licensed under the GNU General Public License, version 3."),
    ("cc-by-nc-short", "Licensed under CC BY-NC 4.0."), ("cc-by-nc-long", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("bsd-3-text", BSD3), ("gpl2-header", GPL2), ("gpl2-only-header", GPL2_ONLY), ("agpl3-header", AGPL3), ("lgpl2-header", LGPL2), ("lgpl3-header", LGPL3), ("mpl2-header", MPL2), ("mpl2-header-2", MPL2.replace("http:", "https:")),
    ("epl2-header", EPL2), ("unlicense-text", UNLICENSE), ("zlib-text", ZLIB), ("cc0-notice", CC0), ("boost-header", "Distributed under the Boost Software License, Version 1.0."), ("mit-title", "The MIT License (MIT)"),
    ("cc-by-sa-short", "Licensed under CC BY-SA 4.0."), ("cc-by-sa-long", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    *((rule, f"SPDX-License-Identifier: {name}") for rule, name in (("spdx-mit", "MIT"), ("spdx-apache", "Apache-2.0"), ("spdx-bsd-2", "BSD-2-Clause"), ("spdx-bsd-3", "BSD-3-Clause"), ("spdx-gpl-2-only", "GPL-2.0-only"), ("spdx-gpl-2", "GPL-2.0-or-later"), ("spdx-gpl-3", "GPL-3.0-or-later"), ("spdx-lgpl-2-1", "LGPL-2.1-or-later"), ("spdx-agpl-3", "AGPL-3.0-or-later"), ("spdx-mpl", "MPL-2.0"), ("spdx-isc", "ISC"), ("spdx-cc0", "CC0-1.0"))),
    ("cc-by-short", "Licensed under CC BY 4.0."), ("cc-by-long", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
]


def test_every_licence_rule_on_its_verbatim_text(spark):
    layouts = {
        "wrapped": lambda t: t,
        "paragraphs": lambda t: "\n\n".join(" ".join(p.split()) for p in t.split("\n\n")),
        "one line": lambda t: " ".join(t.split()),
        "comment": lambda t: "".join(f"# {line}".rstrip() + "\n" for line in t.splitlines()),
        "url in its paragraph": lambda t: t.replace("at\n\n", "at\n"),
    }
    run_on = {("apache-header", "one line"): "apache-header-3", ("apache-header", "comment"): "apache-header-3", ("apache-header", "url in its paragraph"): "apache-header-2"}
    rows = [(i * 10 + j, how(text), run_on.get((rule, name), rule)) for i, (rule, text) in enumerate(VERBATIM) for j, (name, how) in enumerate(layouts.items())]
    assert {r[2] for r in rows} == {r[0] for r in licenses.RULES}
    documents = [(i, t) for i, t, _ in rows]
    got = sorted(tuple(r) for r in license_scan(spark.createDataFrame(documents, "doc_id long, text string")).collect())
    assert [(r[0], r[1], r[3]) for r in got] == [(i, rule, 1) for i, _, rule in rows]


def brute_leaks(docs, items, least=0.8):
    out = {}
    for key, text in docs:
        words = (text or "").lower().encode().split()
        for item, item_text in items:
            theirs = (item_text or "").lower().encode().split()
            size = len(theirs)
            if not size:
                continue
            k = min(5, size)
            want = Counter(tuple(theirs[i : i + k]) for i in range(size - k + 1))
            best = 0.0
            for s in range(max(1, len(words) - size + 1)):
                window = words[s : s + size]
                have = Counter(tuple(window[i : i + k]) for i in range(len(window) - k + 1))
                if have:
                    best = max(best, sum((have & want).values()) / sum((have | want).values()))
            if best >= least:
                out[key, item] = round(best, 6)
    return out


def leaky(seed=3):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(40))
    items = [(i, " ".join(word() for _ in range(rng.choice([2, 4, 5, 9, 30, 50])))) for i in range(12)] + [(90, None), (91, " ")]
    docs = []
    for d in range(40):
        words = [word() for _ in range(rng.randrange(120))]
        if d % 2:
            planted = items[rng.randrange(12)][1].split()
            for _ in range(rng.randrange(3)):
                planted[rng.randrange(len(planted))] = word()
            at = rng.randrange(len(words) + 1)
            words[at:at] = planted
        docs.append((d, " ".join(words)))
    return docs, items


def test_leaks_are_those_of_all_windows(spark):
    docs, items = leaky()
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in got.collect()} == brute_leaks(docs, items)


def moved(seed=8):
    """Documents with items whose halves are swapped, with words put in, taken out and replaced, cut short, or next to frequent shingles."""
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefghij") + str(rng.randrange(400))
    common = [word() for _ in range(6)]
    items = [(i, [word() for _ in range(rng.choice([12, 30, 60, 120]))] + common * (i % 3 == 0)) for i in range(10)]
    docs = []
    for d in range(60):
        words = list(items[d % 10][1])
        at = rng.randrange(1, len(words))
        change = d % 6
        if change == 0:
            words = words[at:] + words[:at]
        elif change == 1:
            words[at:at] = [word() for _ in range(rng.randrange(1, 4))]
        elif change == 2:
            del words[at : at + rng.randrange(1, 4)]
        elif change == 3:
            words[at] = word()
        elif change == 4:
            words = words[: 1 + len(words) * 9 // 10] if d % 12 == 4 else words[len(words) // 8 :]
            docs.append((100 + d, " ".join(words)))
        around = [[word() for _ in range(rng.randrange(80))] + common * rng.randrange(3) for _ in range(2)]
        docs.append((d, " ".join(around[0] + words + around[1])))
    return docs, [(i, " ".join(w)) for i, w in items]


def test_leaks_that_moved(spark):
    docs, items = moved()
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    expected = brute_leaks(docs, items)
    assert len(expected) > 40
    assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in got.collect()} == expected


def test_swapped_halves(spark):
    a, b, other = ([f"{c}{i}" for i in range(60)] for c in "abx")
    text = lambda *parts: " ".join(w for p in parts for w in p)
    docs = spark.createDataFrame([(1, text(other, other, b, a, other)), (2, text(other, a, b)), (3, text(a, other, b))], "doc_id long, text string")
    got = leaks(docs, spark.createDataFrame([(7, text(a, b))], "item_id long, text string"))
    assert sorted((r.doc_id, round(r.similarity, 3), r.start_word) for r in got.collect()) == [(1, 0.933, 120), (2, 1.0, 60)]


def test_leaks_without_broadcast(spark, monkeypatch):
    import loomseq.llm.decontaminate as D

    monkeypatch.setattr(D, "BROADCAST_SHINGLES", 0)
    monkeypatch.setattr(D, "BROADCAST_DOCUMENTS", 0)
    docs, items = leaky(5)
    got = leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id): round(r.similarity, 6) for r in got.collect()} == brute_leaks(docs, items)


def test_decontamination_of_odd_rows(spark, nasty, empty):
    items = spark.createDataFrame([(1, "a row without an id but with quite some words in it, as many as a sentence may have"), (2, "word")], "item_id long, text string")
    kept = clean_documents(nasty, items)
    assert kept.columns == nasty.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "2", "3", "4", "6", "6", "7", "8"]
    assert clean_documents(empty, items).count() == 0
    assert clean_documents(nasty, items.where("false")).count() == nasty.count()


URLS = [
    (1, "http://a.example.net/en/x"),
    (2, "https://example.net/fr/"),
    (3, "HTTP://WWW.Example.COM/de/page?x=/en/#y"),
    (4, "http://b.org"),
    (5, None),
    (6, "no scheme"),
    (7, "http://q.org/fr/a"),
    (8, "x://u://v/w"),
    (9, "http://notexample.com/de/"),
    (10, ""),
    (10, "http://b.org/fr"),
    (11, "http://b.org?x"),
    (12, "http://a\nb.net/\nz"),
]


def test_urls_and_sql_agree(spark):
    import pandas as pd

    pages = pd.DataFrame(URLS, columns=["page_id", "url"])  # noqa: F841  read by DuckDB
    labels = pd.DataFrame({"doc_id": [1, 2, 4, 7, 7, 99], "quality": [0, 1, 1, 0, 1, 0], "toxic": [0, 0, 0, 1, 0, 0]})
    df = spark.createDataFrame(URLS, "page_id long, url string")
    marks = spark.createDataFrame([(int(r.doc_id), bool(r.quality == 0 or r.toxic == 1)) for r in labels.itertuples()], "page_id long, bad boolean")
    got = sorted((tuple(r) for r in judge_urls(df, marks).drop("bad_bound").collect()), key=str)
    rows = sorted((tuple(None if x != x else x for x in r) for r in duckdb.sql(url_filter.oracle_sql()).fetchall()), key=str)
    assert got == rows
    by = {r[0]: r for r in got if r[0] != 10}
    assert by[1][1:] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert by[2][3:] == ("net/", "block")
    assert by[3][1:] == ("www.example.com", "/de/page", "example.com/de/", "block")
    assert by[5][1:3] == ("", "") == by[6][1:3]
    assert by[8][1:3] == ("u:", "//v/w")
    assert by[9][3] is None


def test_no_labels_block_nothing(spark):
    df = spark.createDataFrame(URLS, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    assert judge_urls(df, none, rules=[]).where("verdict = 'block'").count() == 0
    assert judge_urls(df.where("false"), none).count() == 0


def test_bad_hosts_are_blocked_and_good_ones_shrink_towards_their_domain(spark):
    labelled = [(f"h{i}.good.com", 40.0, 1.0) for i in range(10)] + [("bad.com", 50.0, 48.0), ("one.bad.com", 1.0, 1.0)]
    hosts = spark.createDataFrame([(h,) for h in ("bad.com", "h1.good.com", "new.good.com", "new.org")], "host string")
    reputation, rate = host_reputation(hosts, spark.createDataFrame(labelled, "host string, n double, bad double"))
    got = {r.host: r for r in reputation.collect()}
    assert got["bad.com"].bad_bound > 0.5 > rate > got["h1.good.com"].bad_mean
    assert got["new.good.com"].bad_mean < got["new.org"].bad_mean


def test_half_filled_labels_do_not_count(spark, tmp_path):
    import pandas as pd
    from loomseq.llm.queries import op9_url_filters

    pages = pd.DataFrame([(i, f"http://h{i % 2}.test/") for i in range(40)], columns=["page_id", "url"])
    # h0: half-filled bad ones and whole good ones; h1: whole bad ones and half-filled good ones.
    half = {0: [(0, None), (None, 1), (1, 0)], 1: [(0, 0), (1, None), (None, 0)]}
    labels = [(i, *half[i % 2][i // 2 % 3]) for i in range(40)]
    spark.createDataFrame(list(pages.itertuples(index=False, name=None)), "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    labels = duckdb.sql(f"select * from read_parquet('{tmp_path}/labels.parquet/*.parquet')")  # noqa: F841  read by DuckDB
    got = sorted((tuple(r) for r in op9_url_filters(spark, str(tmp_path)).collect()))
    assert got == sorted(duckdb.sql(url_filter.oracle_sql()).fetchall())
    assert {(r[1], r[4]) for r in got} == {("h0.test", "allow"), ("h1.test", "block")}


def test_many_rules_ties_and_levels(spark):
    rules = [("block", f"r{i}.test", "/") for i in range(3000)] + [("allow", "a.b", "/xy"), ("block", "b", "/xyzw"), ("allow", "b", "/xyzw")]
    urls = [(1, "http://r17.test/"), (2, "http://s.r2999.test/q"), (3, "http://a.b/xyzw"), (4, "http://c.b/xyzw"), (5, "http://xr17.test/"), (6, "http://r17.test")]
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(spark.createDataFrame(urls, "page_id long, url string"), none, rules=rules).collect()}
    assert got == {1: ("r17.test/", "block"), 2: ("r2999.test/", "block"), 3: ("a.b/xy", "allow"), 4: ("b/xyzw", "block"), 5: (None, "allow"), 6: (None, "allow")}
    hosts = [("a.foo.co.uk",), ("foo.com:8080",), ("10.1.2.3",), ("co.uk",), ("x",), ("",)]
    levels = {r.host: (r.domain, r.suffix) for r in url_filter._levels(spark.createDataFrame(hosts, "host string"), url_filter.SUFFIXES).collect()}
    assert levels == {"a.foo.co.uk": ("foo.co.uk", "co.uk"), "foo.com:8080": ("foo.com", "com"), "10.1.2.3": ("10.1.2.3",) * 2, "co.uk": ("co.uk", "co.uk"), "x": ("x", "x"), "": ("", "")}


def test_reputation_decides_some_pages_of_the_query(spark, tmp_path):
    from loomseq.llm.queries import op9_url_filters

    rng = random.Random(5)
    hosts = [f"{'bad' if i < 3 else 'good'}{i}.shop.co.uk:80" for i in range(12)] + ["10.0.0.7", "x.org"]
    pages = [(i, f"http://{rng.choice(hosts)}/p{i}", "page_id", None) for i in range(900)]
    labels = [(i, int(rng.random() > (0.8 if "bad" in pages[i][1] else 0.15)), 0, "host") for i in range(0, 900, 2)]
    spark.createDataFrame(pages, "page_id long, url string, host string, bad string").write.parquet(f"{tmp_path}/pages.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int, host string").write.parquet(f"{tmp_path}/labels.parquet")
    pages, labels = (duckdb.sql(f"select * from read_parquet('{tmp_path}/{t}.parquet/*.parquet')") for t in ("pages", "labels"))  # noqa: F841  read by DuckDB
    got = sorted((tuple(r) for r in op9_url_filters(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted(duckdb.sql(url_filter.oracle_sql()).fetchall(), key=str)
    assert {"bad" in r[1] for r in got if r[4] == "block"} == {True} and {"bad" in r[1] for r in got if r[4] == "allow"} == {False}


def test_windows_are_only_of_lengths_whose_items_share_their_shingles(spark, monkeypatch):
    """A passage of a long item makes no windows of the lengths of short ones."""
    import loomseq.llm.decontaminate as D

    kept, keep = {}, D.Scratch.keep

    def told(self, df, name):
        out = keep(self, df, name)
        kept[name] = out.count()
        return out

    monkeypatch.setattr(D.Scratch, "keep", told)
    items = [(0, " ".join(f"w{j}" for j in range(200)))] + [(i, " ".join(f"x{i}y{j}" for j in range(20 + i))) for i in range(1, 20)]
    found = leaks(spark.createDataFrame([(1, "before " + items[0][1] + " after"), (2, items[5][1])], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id, r.similarity) for r in found.collect()} == {(1, 0, 1.0), (2, 5, 1.0)}
    assert kept["windows"] < 50
