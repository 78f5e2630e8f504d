"""Licence scans by sentence recognition.

A text is cut into pieces at line ends and after sentence marks, each
normalised (lower case, words only).  A known licence sentence is one piece,
or several that only line ends part; each is mapped to its identifier, so
whole lines and sentences wrapped over lines count side by side.  The sequence of
identifiers is then matched against ordered rules.  A rule consumes the
identifiers it matches, so a longer licence listed first is not reported
again by the shorter rules below it.

Everything is Column expressions over one pass of the documents.  Texts
without any of the key words of which every known sentence holds one are not
cut up at all: they cannot hold a known sentence.

Defined results: a sentence of open end takes the unknown lines that follow
it up to the next sentence mark or blank line, if none of them is known; a null, empty or unlicensed text has an empty list;
unknown sentences between known ones break a rule's sequence; a licence
found twice is listed twice; repeated rows give repeated results; an empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNDER = r"(?:this (?:work|program|file|software|library|project) is )?(?:released|licensed|available|distributed) under (?:the )?(?:terms of the )?"
VERSION = r"(?:(?: version)? ?v? ?[23](?: 0)?(?: or (?:any )?later(?: version)?| only)?)?"
SEE = r"(?: see .*)?"
CC = r"(?:an? )?(?:cc {}|creative commons {})(?: ?v?4 0)?(?: international)?(?: license)?"
SPDX = "spdx license identifier "
# Normalised sentences of public licence texts, by identifier.
# A pattern must match a whole normalised sentence.
SENTENCES = (
    ("apache_name", UNDER + r"apache(?: software)?(?: license)?(?: version)? ?v?2(?: 0)?(?: the license| license)?" + SEE),
    ("apache_use", r"you may not use this (?:file|work|software) except in compliance with the license"),
    ("apache_copy", r"you may obtain a copy of the license at(?: http.*)?"),
    ("apache_asis", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("mit_name", UNDER + r"mit(?: license)?" + SEE),
    ("mit_title", r"(?:the )?mit license(?: mit)?"),
    ("mit_grant", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files.*"),
    ("mit_notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit_asis", r"the software is provided as is without warranty of any kind express or implied.*"),
    ("bsd_redist", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("bsd_source", r"(?:1 )?redistributions of source code must retain the above copyright notice.*"),
    ("bsd_binary", r"(?:2 )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("bsd_endorse", r"(?:3 )?neither the name of .* may be used to endorse or promote products derived from this software.*"),
    ("gpl_name", UNDER + r"(?:gnu general public license|(?:gnu )?gpl)" + VERSION + SEE),
    ("agpl_name", UNDER + r"(?:gnu affero general public license|(?:gnu )?agpl)" + VERSION + SEE),
    ("agpl_free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license.*"),
    ("gpl_free", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license.*"),
    ("lgpl_name", r"(?:this (?:work|library) is )?(?:released|licensed|available|distributed) under (?:the )?gnu lesser general public license.*"),
    ("lgpl_short", UNDER + r"(?:gnu )?lgpl(?: ?v?[23](?: [01])?)?(?: or (?:any )?later(?: version)?| only)?" + SEE),
    ("lgpl_free", r"this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license.*"),
    ("mpl_name", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl_under", UNDER + r"(?:mozilla public license|mpl)(?: version)? ?v?2(?: 0)?" + SEE),
    ("epl_name", UNDER + r"(?:eclipse public license|epl)(?: version)? ?v? ?2(?: 0)?" + SEE),
    ("isc_name", UNDER + r"isc license" + SEE),
    ("isc_grant", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted.*"),
    ("bsd3_name", UNDER + r"(?:bsd 3 clause|3 clause bsd)(?: license)?" + SEE),
    ("bsd2_name", UNDER + r"(?:bsd 2 clause|2 clause bsd)(?: license)?" + SEE),
    ("ccbyncsa_name", UNDER + CC.format("by nc sa", "attribution noncommercial sharealike") + SEE),
    ("ccbyncnd_name", UNDER + CC.format("by nc nd", "attribution noncommercial noderivatives") + SEE),
    ("ccbynd_name", UNDER + CC.format("by nd", "attribution noderivatives") + SEE),
    ("ccbync_name", UNDER + CC.format("by nc", "attribution noncommercial") + SEE),
    ("ccbysa_name", UNDER + CC.format("by sa", "attribution sharealike") + SEE),
    ("ccby_name", UNDER + CC.format("by", "attribution") + SEE),
    ("cc0_name", r"(?:(?:released|licensed|available|distributed) under )?(?:the )?(?:cc0|cc0 1 0)(?: universal)?(?: license)?"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("copyright", r"copyright (?:c )?[0-9]{4}.*"),
    ("reserved", r"all rights reserved"),
    ("spdx_mit", SPDX + "mit"),
    ("spdx_apache", SPDX + "apache 2 0"),
    ("spdx_bsd3", SPDX + "bsd 3 clause"),
    ("spdx_bsd2", SPDX + "bsd 2 clause"),
    ("spdx_gpl", SPDX + r"gpl [23] 0(?: only| or later)?"),
    ("spdx_agpl", SPDX + r"agpl 3 0(?: only| or later)?"),
    ("spdx_lgpl", SPDX + r"lgpl [23] [01](?: only| or later)?"),
    ("spdx_mpl", SPDX + "mpl 2 0"),
    ("spdx_epl", SPDX + "epl 2 0"),
    ("spdx_isc", SPDX + "isc"),
    ("spdx_ccbyncsa", SPDX + "cc by nc sa 4 0"),
    ("spdx_ccbyncnd", SPDX + "cc by nc nd 4 0"),
    ("spdx_ccbynd", SPDX + "cc by nd 4 0"),
    ("spdx_ccbync", SPDX + "cc by nc 4 0"),
    ("spdx_ccbysa", SPDX + "cc by sa 4 0"),
    ("spdx_ccby", SPDX + "cc by 4 0"),
    ("spdx_cc0", SPDX + "cc0 1 0"),
    ("spdx_unlicense", SPDX + "unlicense"),
)
# Ordered rules, licence and its sequence of identifiers.
RULES = (
    ("MIT", "mit_title copyright mit_grant mit_notice mit_asis"),
    ("MIT", "mit_grant mit_notice mit_asis"),
    ("Apache-2.0", "apache_name apache_use apache_copy apache_asis"),
    ("BSD-3-Clause", "bsd_redist bsd_source bsd_binary bsd_endorse"),
    ("BSD-2-Clause", "bsd_redist bsd_source bsd_binary"),
    ("Apache-2.0", "apache_name"),
    ("MIT", "mit_name"),
    ("MIT", "mit_grant"),
    ("GPL", "gpl_name"),
    ("GPL", "gpl_free"),
    ("LGPL", "lgpl_name"),
    ("MPL-2.0", "mpl_name"),
    ("CC-BY-NC-4.0", "ccbync_name"),
    ("CC-BY-SA-4.0", "ccbysa_name"),
    ("CC-BY-4.0", "ccby_name"),
    ("CC0-1.0", "cc0_name"),
    ("Unlicense", "unlicense"),
    ("Proprietary", "copyright reserved"),
    ("AGPL", "agpl_name"),
    ("AGPL", "agpl_free"),
    ("LGPL", "lgpl_short"),
    ("LGPL", "lgpl_free"),
    ("MPL-2.0", "mpl_under"),
    ("EPL-2.0", "epl_name"),
    ("ISC", "isc_name"),
    ("ISC", "isc_grant"),
    ("BSD-3-Clause", "bsd3_name"),
    ("BSD-2-Clause", "bsd2_name"),
    ("CC-BY-NC-SA-4.0", "ccbyncsa_name"),
    ("CC-BY-NC-ND-4.0", "ccbyncnd_name"),
    ("CC-BY-ND-4.0", "ccbynd_name"),
    ("MIT", "spdx_mit"),
    ("Apache-2.0", "spdx_apache"),
    ("BSD-3-Clause", "spdx_bsd3"),
    ("BSD-2-Clause", "spdx_bsd2"),
    ("GPL", "spdx_gpl"),
    ("AGPL", "spdx_agpl"),
    ("LGPL", "spdx_lgpl"),
    ("MPL-2.0", "spdx_mpl"),
    ("EPL-2.0", "spdx_epl"),
    ("ISC", "spdx_isc"),
    ("CC-BY-NC-SA-4.0", "spdx_ccbyncsa"),
    ("CC-BY-NC-ND-4.0", "spdx_ccbyncnd"),
    ("CC-BY-ND-4.0", "spdx_ccbynd"),
    ("CC-BY-NC-4.0", "spdx_ccbync"),
    ("CC-BY-SA-4.0", "spdx_ccbysa"),
    ("CC-BY-4.0", "spdx_ccby"),
    ("CC0-1.0", "spdx_cc0"),
    ("Unlicense", "spdx_unlicense"),
)
#: Every text that holds a known sentence, however its words are parted, holds one of these.
KEYS = (r"(?i)licen[sc]e|permission|copyright|redistribut|warranty|endorse|cc0|unencumbered|rights[^a-z0-9]+reserved"
        r"|(?:released|available|distributed)[^a-z0-9]+under")


# Ends of pieces in a prepared text: SOFT, a line end that a sentence may run
# over; HARD, a sentence mark or a blank line.
SOFT, HARD = r"\n", r"\x0b"


def prepare(text: Column) -> Column:
    """The words of a text in lower case, its pieces parted by SOFT and HARD."""
    steps = ((r"(?<=[.;:!?])(?<!(?i:license-identifier:))(?:[ \t\r]*\n|[ \t]+)|\n\r?\n", "\x0b"), (r"[^a-z0-9\n\x0b]+", " "),
             (r" ?\n[ \n]*", "\n"), (r"[ \n]?\x0b[ \n\x0b]*", "\x0b"), (r"^[ \n\x0b]+|[ \n\x0b]+$", ""))
    for k, (pattern, to) in enumerate(steps):
        text = F.regexp_replace(F.lower(text) if k == 1 else text, pattern, to)
    return text


def over_lines(pattern: str) -> str:
    """A sentence's pattern as whole pieces of a prepared text: it may go on
    after a SOFT end wherever it has a blank; an open end is that of its line."""
    inner = pattern.removesuffix(".*").replace(".*", rf"[^<{HARD}]*?")
    inner = inner.replace("http[^<" + HARD + "]*?", rf"http[^{SOFT}{HARD}]*").replace(" ", rf"[ {SOFT}]")
    end = rf"[^{SOFT}{HARD}]*" if pattern.endswith(".*") else ""
    return rf"(?<![^{SOFT}{HARD}])(?:{inner}){end}(?![^{SOFT}{HARD}])"


def identify(text: Column) -> Column:
    """A prepared text with every known sentence as its <identifier>; of two
    that overlap the first of SENTENCES counts."""
    for name, pattern in SENTENCES:
        text = F.regexp_replace(text, over_lines(pattern), f"<{name}>")
    ends = "|".join(name for name, pattern in SENTENCES if pattern.endswith(".*"))
    return F.regexp_replace(text, rf"(<(?:{ends})>){SOFT}[^<{HARD}]*+(?![^{HARD}])", "$1")


def licences(ids: Column) -> Column:
    """Licences of a sequence of identifiers, in order of appearance."""
    line = F.concat(F.lit(" "), F.array_join(F.transform(ids, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), " "), F.lit(" "))
    for licence, rule in RULES:
        found = " ".join(f"<{x}>" for x in rule.split())
        line = F.replace(line, F.lit(f" {found} "), F.lit(f" ={licence} "))
        # a second pass takes neighbours that shared the blank between them
        line = F.replace(line, F.lit(f" {found} "), F.lit(f" ={licence} "))
    return F.transform(F.filter(F.split(line, " "), lambda x: x.startswith("=")), lambda x: F.substring(x, 2, 99))


def _ids(text: Column) -> Column:
    """Identifiers in order; a run of unknown sentences is one '-'; the
    number of a list item is no sentence."""
    ids = F.transform(F.split(identify(prepare(text)), rf"[{SOFT}{HARD}]"), lambda x: F.when(
        x.startswith("<"), F.regexp_replace(x, "[<>]", "")).when(x.rlike("[a-z]"), "-"))
    line = F.array_join(F.filter(ids, lambda x: x.isNotNull()), " ")
    folded = F.regexp_replace(line, "(?:^| )-(?: -)*(?= |$)", " -")
    return F.filter(F.split(folded, " "), lambda x: x != "")


def _known(ids: Column) -> Column:
    return F.size(F.filter(ids, lambda x: x != "-"))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, sentence_ids array<string> (known ones in order, '-' for runs
    of unknown ones between them) and licences array<string>."""
    body = F.when(F.col(text).rlike(KEYS), F.col(text))
    df = docs.select("doc_id", _ids(body).alias("_ids"))
    none = F.expr("cast(array() as array<string>)")
    has = F.coalesce(_known(F.col("_ids")) > 0, F.lit(False))
    return df.select(
        "doc_id", F.when(has, F.col("_ids")).otherwise(none).alias("sentence_ids"),
        F.when(has, licences(F.col("_ids"))).otherwise(none).alias("licences"))
