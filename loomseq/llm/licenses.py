"""License scans by sentence rules.

A text is cut into sentences, each normalised to its lower-case letters and
digits with single spaces. A sentence of the table below becomes its licence-
sentence identifier; rules name a licence by an ordered sequence of
identifiers. A document matches a rule where its own identifiers, in order and
without the sentences between them that are unknown, hold the rule's sequence
next to one another. Longer sequences come first, and what one has matched no
shorter one matches again: three clauses are not two clauses as well. Texts are
read twice, with line ends as sentence ends and with line ends as spaces, so
that wrapped licence texts are found too.

All of it is DataFrame functions, in one pass and without a shuffle; texts that
lack the longest word of every rule are told apart by one search and go no
further.

Defined results: null and empty texts match nothing; a document matches a rule
as often as the sequence occurs; rows that share an id are reported each; a null
id is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, normalised, by identifier. None spans a place where texts
# are cut; where only the layout decides (a blank line around a URL, none in comments), each reading has its own.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "apache-copy-url": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-copy-as-is": "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software",
    "gpl-terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-merchant": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "bsd-terms": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl-terms-2": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-later-2": "either version 2 of the license or at your option any later version",
    "gpl-only-2": "you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation",
    "agpl-terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl-free": "this library is free software",
    "lgpl-terms-2": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl-later-2-1": "either version 2 1 of the license or at your option any later version",
    "lgpl-terms-3": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
    "mpl-copy-s": "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0",
    "epl-2": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0",
    "boost": "distributed under the boost software license version 1 0",
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
    "zlib-as-is": "this software is provided as is without any express or implied warranty",
    "zlib-event": "in no event will the authors be held liable for any damages arising from the use of this software",
    "zlib-grant": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions",
    "cc0-dedicated": "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    "cc0-warranty": "this software is distributed without any warranty",
    "cc-by-nc-notice": "licensed under cc by nc 4 0",
    "cc-by-nc-long": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    "cc-by-notice": "licensed under cc by 4 0",
    "cc-by-long": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-notice": "licensed under cc by sa 4 0",
    "cc-by-sa-long": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "spdx": "spdx license identifier",
    "spdx-mit": "mit",
    "spdx-apache": "apache 2 0",
    "spdx-bsd-2": "bsd 2 clause",
    "spdx-bsd-3": "bsd 3 clause",
    "spdx-gpl-2-only": "gpl 2 0 only",
    "spdx-gpl-2": "gpl 2 0 or later",
    "spdx-gpl-3": "gpl 3 0 or later",
    "spdx-lgpl-2-1": "lgpl 2 1 or later",
    "spdx-agpl-3": "agpl 3 0 or later",
    "spdx-mpl": "mpl 2 0",
    "spdx-isc": "isc",
    "spdx-cc0": "cc0 1 0",
}
#: (rule, licence, identifiers in order).
RULES = [
    ("mit-title", "MIT", ["mit-title"]),
    ("mit-short", "MIT", ["mit-notice"]),
    ("mit-short-2", "MIT", ["mit-notice-2"]),
    ("mit-text", "MIT", ["mit-grant", "mit-keep"]),
    ("isc-text", "ISC", ["isc-grant"]),
    ("apache-short", "Apache-2.0", ["apache-notice"]),
    ("apache-header", "Apache-2.0", ["apache-grant", "apache-use", "apache-copy", "apache-url", "apache-as-is"]),
    ("apache-header-2", "Apache-2.0", ["apache-grant", "apache-use", "apache-copy-url", "apache-as-is"]),
    ("apache-header-3", "Apache-2.0", ["apache-grant", "apache-use", "apache-copy-as-is"]),
    ("gpl3-short", "GPL-3.0", ["gpl3-notice"]),
    ("gpl3-header", "GPL-3.0-or-later", ["gpl-free", "gpl-terms", "gpl-hope", "gpl-merchant"]),
    ("gpl2-header", "GPL-2.0-or-later", ["gpl-free", "gpl-terms-2", "gpl-later-2", "gpl-hope", "gpl-merchant"]),
    ("gpl2-only-header", "GPL-2.0-only", ["gpl-free", "gpl-only-2", "gpl-hope", "gpl-merchant"]),
    ("agpl3-header", "AGPL-3.0-or-later", ["gpl-free", "agpl-terms", "gpl-hope", "gpl-merchant"]),
    ("lgpl2-header", "LGPL-2.1-or-later", ["lgpl-free", "lgpl-terms-2", "lgpl-later-2-1"]),
    ("lgpl3-header", "LGPL-3.0-or-later", ["lgpl-free", "lgpl-terms-3"]),
    ("mpl2-header", "MPL-2.0", ["mpl-subject", "mpl-copy"]),
    ("mpl2-header-2", "MPL-2.0", ["mpl-subject", "mpl-copy-s"]),
    ("epl2-header", "EPL-2.0", ["epl-2"]),
    ("boost-header", "BSL-1.0", ["boost"]),
    ("unlicense-text", "Unlicense", ["unlicense-free", "unlicense-anyone"]),
    ("zlib-text", "Zlib", ["zlib-as-is", "zlib-event", "zlib-grant"]),
    ("cc0-notice", "CC0-1.0", ["cc0-dedicated", "cc0-warranty"]),
    ("bsd-text", "BSD-2-Clause", ["bsd-terms", "bsd-source", "bsd-binary"]),
    ("bsd-3-text", "BSD-3-Clause", ["bsd-terms", "bsd-source", "bsd-binary", "bsd-names"]),
    ("cc-by-nc-short", "CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("cc-by-nc-long", "CC-BY-NC-4.0", ["cc-by-nc-long"]),
    ("cc-by-short", "CC-BY-4.0", ["cc-by-notice"]),
    ("cc-by-long", "CC-BY-4.0", ["cc-by-long"]),
    ("cc-by-sa-short", "CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("cc-by-sa-long", "CC-BY-SA-4.0", ["cc-by-sa-long"]),
    ("spdx-mit", "MIT", ["spdx", "spdx-mit"]),
    ("spdx-apache", "Apache-2.0", ["spdx", "spdx-apache"]),
    ("spdx-bsd-2", "BSD-2-Clause", ["spdx", "spdx-bsd-2"]),
    ("spdx-bsd-3", "BSD-3-Clause", ["spdx", "spdx-bsd-3"]),
    ("spdx-gpl-2-only", "GPL-2.0-only", ["spdx", "spdx-gpl-2-only"]),
    ("spdx-gpl-2", "GPL-2.0-or-later", ["spdx", "spdx-gpl-2"]),
    ("spdx-gpl-3", "GPL-3.0-or-later", ["spdx", "spdx-gpl-3"]),
    ("spdx-lgpl-2-1", "LGPL-2.1-or-later", ["spdx", "spdx-lgpl-2-1"]),
    ("spdx-agpl-3", "AGPL-3.0-or-later", ["spdx", "spdx-agpl-3"]),
    ("spdx-mpl", "MPL-2.0", ["spdx", "spdx-mpl"]),
    ("spdx-isc", "ISC", ["spdx", "spdx-isc"]),
    ("spdx-cc0", "CC0-1.0", ["spdx", "spdx-cc0"]),
]
_CHUNK_END = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+$|\n+"
_JOINED_END = r"[.!?;:]+[\x20\x09-\x0D]+|[.!?;:]+$|\n[\x20\x09]*\n\s*"
_OTHER = r"[^a-z0-9]+"


def _sentences(text: Column, ends: str) -> Column:
    """Normalised sentences: cut first, since the normal form has no ends left."""
    cut = F.split(F.lower(text), ends)
    return F.transform(cut, lambda s: F.btrim(F.regexp_replace(s, _OTHER, " ")))


def _longest_first(rules: list[tuple[str, str, list[str]]]) -> list[tuple[str, str, str]]:
    """(rule, licence, the sequence as it stands among joined identifiers)."""
    return [(rule, licence, "".join(f"|{s}|" for s in sequence)) for rule, licence, sequence in sorted(rules, key=lambda r: -len(r[2]))]


_TAKEN = "|#|"


def _counts(ids: Column, rules: list[tuple[str, str, list[str]]]) -> dict[str, Column]:
    """Matches of each rule."""
    left, counts = F.concat(F.lit("|"), F.array_join(ids, "||"), F.lit("|")), {}
    for rule, _, wanted in _longest_first(rules):
        after = F.replace(left, F.lit(wanted), F.lit(_TAKEN))
        counts[rule] = ((F.length(left) - F.length(after)) / (len(wanted) - len(_TAKEN))).cast("long")
        left = after
    return counts


def _rare_words(sentences: dict[str, str], rules: list[tuple[str, str, list[str]]]) -> str:
    """A search that every text that matches a rule passes: the longest word of each rule's sentences."""
    return "(?i)" + "|".join(sorted({max((w for s in sequence for w in sentences[s].split()), key=lambda w: (len(w), w)) for _, _, sequence in rules}))


def license_scan(docs: DataFrame, sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, str, list[str]]] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` and rule that it matches: doc_id, rule, licence, n_matches."""
    known = F.create_map(*(F.lit(x) for key, s in sentences.items() for x in (s, key)))
    text = F.col("text")
    maybe = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).where(text.rlike(_rare_words(sentences, rules)))
    ids = lambda ends: F.filter(F.transform(_sentences(text, ends), lambda s: F.try_element_at(known, s)), lambda k: k.isNotNull())
    found = maybe.select("doc_id", ids(_CHUNK_END).alias("by_line"), ids(_JOINED_END).alias("by_text")).where("size(by_line) > 0 or size(by_text) > 0")
    by_line, by_text = _counts(F.col("by_line"), rules), _counts(F.col("by_text"), rules)
    matches = [F.struct(F.lit(rule).alias("rule"), F.lit(licence).alias("licence"), F.greatest(by_line[rule], by_text[rule]).alias("n_matches")) for rule, licence, _ in rules]
    return found.select("doc_id", F.explode(F.array(*matches)).alias("m")).select("doc_id", "m.*").where("n_matches > 0")


def oracle_sql(sentences: dict[str, str] = SENTENCES, rules: list[tuple[str, str, list[str]]] = RULES) -> str:
    """DuckDB SQL for the registered query."""
    names = ", ".join(f"'{k}'" for k in sentences)
    texts = ", ".join(f"'{s}'" for s in sentences.values())
    sql = lambda p: p.replace("\\x20\\x09-\\x0D", " \\t-\\r").replace("\\x20\\x09", " \\t")
    ids = lambda ends: f"'|' || array_to_string(list_filter(list_transform(string_split_regex(lower(coalesce(text, '')), '{sql(ends)}'), lambda s: known[trim(regexp_replace(s, '{_OTHER}', ' ', 'g'))]), lambda k: k is not null), '||') || '|'"
    steps = _longest_first(rules)
    lefts = ", ".join(f"replace({side}{i}, '{wanted}', '{_TAKEN}') as {side}{i + 1}" for i, (_, _, wanted) in enumerate(steps) for side in "lt")
    count = lambda side, i, wanted: f"(length({side}{i}) - length({side}{i + 1})) / {len(wanted) - len(_TAKEN)}"
    rows = " union all ".join(f"select doc_id, '{rule}' as rule, '{licence}' as licence, cast(greatest({count('l', i, wanted)}, {count('t', i, wanted)}) as bigint) as n_matches from taken" for i, (rule, licence, wanted) in enumerate(steps))
    return f"""
with k as (select map([{texts}], [{names}]) as known),
found as materialized (select * from (select doc_id, {ids(_CHUNK_END)} as l0, {ids(_JOINED_END)} as t0 from documents, k) where length(l0) > 2 or length(t0) > 2),
taken as materialized (select *, {lefts} from found)
select * from ({rows}) where n_matches > 0
"""
