"""Licence recognition by sentences: sentence identifiers first, then ordered rules over their sequence. JVM only.

A text is normalised (lower case, letters, digits and dots only) with a mark at each sentence end and line break. A known
licence sentence is found where it stands between two marks, a long one also behind a title on its line. Single line
breaks inside it count as blanks, so wrapped and commented texts give the same sentences as unwrapped ones; a blank line or
a sentence end is never crossed. The identifiers found, in text order, form a sequence. Rules, in order, each consume every
run of identifiers they state; what is left belongs to no licence.

Defined results: null or empty text has no sentence; repeated rows are scanned each; an empty table gives no row; other
columns of the input are ignored. Sentences without an identifier don't break a sequence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences of licence texts and references, normalised, with an identifier of our own. A word ``*``
# stands for the name of a holder, of up to ``NAME`` words.
SENTENCES = {
    "licensed under the apache license version 2.0": "ApacheRef",
    "licensed under the apache license version 2.0 the license": "ApacheRef",
    "you may not use this file except in compliance with the license": "ApacheUse",
    "you may obtain a copy of the license at": "ApacheCopy",
    "released under the mit license": "MitRef",
    "licensed under the mit license": "MitRef",
    "this software is released under the mit license": "MitRef",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "MitGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied": "AsIs",
    "this work is licensed under the gnu general public license version 3": "Gpl3Ref",
    "this program is licensed under the gnu general public license version 3": "Gpl3Ref",
    "this work is licensed under the gnu general public license version 2": "Gpl2Ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
    "license as published by the free software foundation": "GplGrant",
    "either version 3 of the license or at your option any later version": "Version3OrLater",
    "either version 2 of the license or at your option any later version": "Version2OrLater",
    "licensed under cc by nc 4.0": "CcByNc4Ref",
    "this work is licensed under cc by nc 4.0": "CcByNc4Ref",
    "licensed under cc by 4.0": "CcBy4Ref",
    "licensed under cc by sa 4.0": "CcBySa4Ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse": "BsdEndorse",
    "all rights reserved": "AllRights",
    # The same sentences at the length they have in the full texts.
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights "
    "to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to "
    "whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "the above copyright notice and this permission notice including the next paragraph shall be included in all copies or "
    "substantial portions of the software": "MitNotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "AsIs",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name * nor the names of * contributors may be used to endorse or promote products derived from this "
    "software without specific prior written permission": "BsdEndorse",
    "the name of * may not be used to endorse or promote products derived from this software without specific prior "
    "written permission": "BsdEndorse",
    "license shall mean the terms and conditions for use reproduction and distribution as defined by sections 1 through 9 "
    "of this document": "ApacheRef",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
    "software foundation": "GplGrant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
    "software foundation either version 3 of the license or at your option any later version": "Gpl3Grant",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free "
    "software foundation either version 2 of the license or at your option any later version": "Gpl2Grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
    "free software foundation": "LgplGrant",
    "either version 2.1 of the license or at your option any later version": "Version21OrLater",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
    "free software foundation either version 2.1 of the license or at your option any later version": "Lgpl21Grant",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the "
    "free software foundation either version 3 of the license or at your option any later version": "Lgpl3Grant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the "
    "free software foundation": "AgplGrant",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the "
    "free software foundation either version 3 of the license or at your option any later version": "Agpl3Grant",
    "this source code form is subject to the terms of the mozilla public license v": "MplGrant",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this is free and unencumbered software released into the public domain": "Unencumbered",
    "to the extent possible under law * has waived all copyright and related or neighboring rights to this work": "CcZeroWaiver",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which "
    "is available at https www eclipse org legal epl 2.0": "Epl2Grant",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 which "
    "is available at http www eclipse org legal epl 2.0": "Epl2Grant",
}
NAME = 100  # documented bound: a sentence whose holder has a longer name isn't known
LONG = 20  # words from which a sentence needs no mark in front: a title without an end may stand there
# In order, the sequence a rule consumes and the licence it stands for. Longer sequences come first.
RULES = (
    (("BsdGrant", "BsdSource", "BsdBinary", "BsdEndorse"), "BSD-3-Clause"),
    (("BsdGrant", "BsdSource", "BsdBinary"), "BSD-2-Clause"),
    (("MitGrant", "MitNotice", "AsIs"), "MIT"),
    (("MitGrant", "MitNotice"), "MIT"),
    (("ApacheRef", "ApacheUse", "ApacheCopy"), "Apache-2.0"),
    (("GplGrant", "Version3OrLater"), "GPL-3.0-or-later"),
    (("GplGrant", "Version2OrLater"), "GPL-2.0-or-later"),
    (("Gpl3Grant",), "GPL-3.0-or-later"),
    (("Gpl2Grant",), "GPL-2.0-or-later"),
    (("LgplGrant", "Version21OrLater"), "LGPL-2.1-or-later"),
    (("LgplGrant", "Version3OrLater"), "LGPL-3.0-or-later"),
    (("AgplGrant", "Version3OrLater"), "AGPL-3.0-or-later"),
    (("Lgpl21Grant",), "LGPL-2.1-or-later"),
    (("Lgpl3Grant",), "LGPL-3.0-or-later"),
    (("Agpl3Grant",), "AGPL-3.0-or-later"),
    (("MplGrant",), "MPL-2.0"),
    (("IscGrant",), "ISC"),
    (("Unencumbered",), "Unlicense"),
    (("CcZeroWaiver",), "CC0-1.0"),
    (("Epl2Grant",), "EPL-2.0"),
    (("ApacheRef",), "Apache-2.0"),
    (("MitRef",), "MIT"),
    (("Gpl3Ref",), "GPL-3.0-only"),
    (("Gpl2Ref",), "GPL-2.0-only"),
    (("CcByNc4Ref",), "CC-BY-NC-4.0"),
    (("CcBySa4Ref",), "CC-BY-SA-4.0"),
    (("CcBy4Ref",), "CC-BY-4.0"),
    (("AllRights",), "Proprietary"),
)
# Every sentence of the table holds one of these words, so a text without them needs no scan.
_GATE = r"(?i)licen[cs]e|permission|warrant|copyright|redistribut|rights\W+reserved|unencumbered"
_END, _LINE = "\u0001", "\u0002"  # marks of sentence ends and line breaks
_SENTENCE_END = r"(?<![.!?;:])[.!?;:]++\s+"


def normalised(text: Column) -> Column:
    """Lower case with marks; other characters than letters, digits and dots inside numbers become one blank."""
    marked = F.regexp_replace(F.translate(F.lower(text), _END + _LINE, "  "), _SENTENCE_END, _END)
    marked = F.regexp_replace(marked, r"\r\n?|\n", _LINE)
    words = F.regexp_replace(marked, rf"[^a-z0-9.{_END}{_LINE}]+|\.(?![0-9])|(?<![0-9])\.", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(words, " {2,}", " "), f" ?([{_END}{_LINE}]) ?", "$1"))


def _pattern(sentence: str) -> str:
    """A known sentence over blanks and single line breaks; the name of a holder may hold a sentence end (Inc.)."""
    name = f"[a-z0-9.]++(?:[ {_END}{_LINE}][a-z0-9.]++){{0,{NAME - 1}}}?"
    return f"[ {_LINE}]".join(name if w == "*" else re.escape(w) for w in sentence.split())


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in its order. Of two that start together the longer one counts."""
    sentences = sentences or SENTENCES
    table = F.create_map(*(F.lit(x) for pair in sentences.items() for x in pair))
    ordered = sorted(sentences, key=lambda s: (-len(s), s))
    every = "|".join(map(_pattern, ordered))
    long = "|".join(_pattern(s) for s in ordered if len(s.split()) >= LONG) or "(?!)"
    # up to a mark, and from one or behind a number of a list
    wanted = f"((?<![^{_END}{_LINE} ])(?:{long})|(?:(?<![^{_END}{_LINE}])|(?<=(?<![^{_END}{_LINE}])[0-9]{{1,2}} ))(?:{every}))(?![^{_END}{_LINE}])"
    hits = F.regexp_extract_all(normalised(text), F.lit(wanted), 1)
    named = [s for s in sentences if "*" in s.split()]

    def identify(hit: Column) -> Column:
        exact = F.element_at(table, F.translate(hit, _LINE, " "))
        return F.coalesce(exact, *(F.when(hit.rlike(f"^(?:{_pattern(s)})$"), F.lit(sentences[s])) for s in named))

    return F.when(text.rlike(_GATE), F.transform(hits, identify)).otherwise(F.array().cast("array<string>"))


def match_rules(ids: Column, rules=RULES) -> tuple[Column, Column]:
    """(licences found, in rule order, once per consumed run; identifiers that no rule consumed)."""
    rest = F.concat(F.lit(""), F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), ""))

    def step(state: Column, rule: Column) -> Column:
        parts = F.split(state["rest"], rule["sequence"], -1)
        return F.struct(
            F.array_join(parts, "|").alias("rest"),
            F.concat(state["found"], F.array_repeat(rule["licence"], F.size(parts) - 1)).alias("found"),
        )

    table = F.array(
        *(F.struct(F.lit("".join(f"<{x}>" for x in seq)).alias("sequence"), F.lit(name).alias("licence")) for seq, name in rules)
    )
    start = F.struct(rest.alias("rest"), F.array().cast("array<string>").alias("found"))
    state = F.when(F.size(ids) > 0, F.aggregate(table, start, step))
    left = F.array_remove(F.split(F.regexp_replace(state["rest"], r"[|<>]+", ","), ","), "")
    empty = F.array().cast("array<string>")
    return F.coalesce(state["found"], empty), F.coalesce(left, empty)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the licence sentences, the licences their sequence states, and what no rule explains."""
    ids = docs.select(
        F.col(id_col).alias("doc_id"), sentence_ids(F.coalesce(F.col(text_col), F.lit(""))).alias("sentence_ids")
    )
    found, left = match_rules(F.col("sentence_ids"))
    return ids.select("doc_id", "sentence_ids", found.alias("licenses"), left.alias("unmatched"))


def license_report(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id",
        F.size("sentence_ids").cast("long").alias("n_sentences"),
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join(F.array_distinct("licenses"), ",").alias("licenses"),
        F.size("unmatched").cast("long").alias("n_unmatched"),
    )
