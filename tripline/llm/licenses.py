"""Licence scans: whole texts looked up by the digest of their canonical form.

Canonical form: lower case, lines that begin with a copyright mark and a year or holder dropped, every run of
signs one blank, equivalent spellings made one (fixed tables below), blanks trimmed; of whole texts, lines
that are a licence's title as well.  The digest is SHA-256.  Two kinds of
text are looked up: a document as a whole, and each of its lines as a text of its own.  The table of known
licences is a parameter, at most ``MAX_KNOWN`` rows (checked), and is broadcast.  Only texts whose canonical
length is that of a known licence are digested, which loses none.

Defined cases: null and empty texts match nothing; repeated rows get equal results; several names of one
digest are one licence, the first by name; an empty table gives no rows; texts
are read whole, a line at a time where lines are looked up; columns but doc_id and text are not read, so
their names may be those of results.  Only DataFrame functions run here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripline.llm.common import table

MAX_KNOWN = 100_000
# Spellings that count as one, replaced in this order in the lower-cased text without signs.
SPELLINGS = (
    ("licence", "license"),
    ("licenced", "licensed"),
    ("organisation", "organization"),
    ("creative commons attribution", "cc by"),
    (" noncommercial", " nc"),
    ("gnu general public license", "gnu gpl"),
)
# Licence names and the texts that declare them.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("WTFPL", "0. You just DO WHAT THE FUCK YOU WANT TO."),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE "
        "OR PERFORMANCE OF THIS SOFTWARE.",
    ),
)
_WARRANTY = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT {} OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
)


def _bsd(clauses: int) -> list[str]:
    """The text with numbers and with bullets, and with each word for whom the warranty names."""
    numbered = "\n".join([_BSD[0], *(f"{i}. {x}" for i, x in enumerate(_BSD[1 : clauses + 1], 1))])
    return [f"{x}\n{_WARRANTY.format(who)}" for x in (numbered, "\n".join(_BSD[: clauses + 1])) for who in ("HOLDER", "HOLDERS", "OWNER")]


# Whole licence texts besides KNOWN's.
TEXTS = (
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions:\n"
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n"
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
    *(("BSD-2-Clause", x) for x in _bsd(2)),
    *(("BSD-3-Clause", x) for x in _bsd(3)),
    *(
        (
            "Unlicense",
            "This is free and unencumbered software released into the public domain.\n"
            "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or "
            "as a compiled binary, for any purpose, commercial or non-commercial, and by any means.\n"
            "In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright "
            "interest in the software to the public domain. We make this dedication for the benefit of the public at large and to "
            "the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity "
            "of all present and future rights to this software under copyright law.\n"
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
            "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE "
            "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT "
            "OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE." + end,
        )
        for end in ("", *(f"\nFor more information, please refer to <{x}://unlicense.org{y}>" for x in ("http", "https") for y in ("", "/")))
    ),
)
# SHA-256 and length of the canonical form of longer licence texts (with http and https links; to the end of the
# terms, and with what follows them).
DIGESTS = (
    ("Apache-2.0", "37599287c15c2f2ec060c3c3b55bdf69e3bc7a8aeeb9cd57e18800088789538a", 8838),
    ("Apache-2.0", "65bfb6f56a10dc6dd6135cf4adeee0f5bc238b3d404067ac48dbf48c0ced3b32", 8839),
    ("Apache-2.0", "f45538b138cf9aea39fa205de037a0bede8305e68281650e7ab809a8b3ebb2f0", 8866),
    ("Apache-2.0", "ed44d69699f98d45c0c3e52ef4574fb05d6045eb6e2cd0e5e3810f6177e87f84", 8867),
    ("Apache-2.0", "e87dea5078ce2faaea46d3475af18d30a5c0ac0f09425b60b3e0c6569f72f8d2", 9882),
    ("Apache-2.0", "ef9aa6097e8b8724e8bedf9a9a264cbc3142b55ef97f3c3f079b7aa1aeac425c", 9884),
    ("GPL-2.0", "f5f16ed9d47f1ad7fbe7c0870bcd2959c99c0443059d2858bf67a0457eb67a8e", 14387),
    ("GPL-2.0", "fd358cc1bde8c83b502dc8841f25cb84cc6f11ba2587f31b838bc2f46abee02d", 14415),
    ("GPL-2.0", "d151c085125fd224532cdad6281a114e4363371bf22a3877367cceb2fc469905", 16992),
    ("GPL-3.0", "b9529120541d3c485a7beb3d330cca5f5810fc89d5edc89140d409d5a0877d41", 30758),
    ("GPL-3.0", "efa6e44e00091c1637623bb83b919a2af9e72d2f9d8aa6f0be80155231f8f271", 30786),
    ("GPL-3.0", "44ba8aa05cca099afe6bb69f94a242984a91bef10fc46aa32a33ee4e0b0428db", 33148),
    ("GPL-3.0", "b8e18cea1002cb24579afe82598eadccbb1adbdd6663520c185839ffef8ff1b2", 33151),
    ("LGPL-2.1", "0a47765285064783ea56d653c6d98fecbd69a24f7a29b9143b78bad78a4c1ef5", 23223),
    ("LGPL-2.1", "80d70fadee5d6e128ca3f66e46b050dda8eedd6b43a20529983e9cb92c4eadbb", 23251),
    ("LGPL-2.1", "70104554f7f007e5aa2b935c6c9065d20efc9fd3924bb30972c9047a8a89d5dd", 25103),
    ("LGPL-3.0", "6cf684c84e8856b24ed793c245fd41a24e51700ab88ed242711e9a4fa3ec5df9", 7066),
    ("MPL-2.0", "3dc53ad82f3586706ea02d522d2a5a2e577f67d6db6445a814a8ba7822ac2a6a", 14322),
    ("MPL-2.0", "251d233846581715b83580ad15017102c06dc11311bf08e47757ad9a6e1c9562", 14323),
)
# Canonical lines that whole texts have or lack, and what follows the marks in licence wording, where no year or holder does.
TITLES = (
    "mit license", "the mit license", "the mit license mit", "isc license", "the isc license", "isc license isc",
    "bsd 2 clause license", "the bsd 2 clause license", "simplified bsd license", "bsd 3 clause license",
    "the bsd 3 clause license", "new bsd license", "the unlicense", "unlicense", "all rights reserved",
)
_WORDING = (
    r"notices?|holders?|owners?|ownership|line|disclaimers?|the\s+(?:software|library|program)|interests?|on|laws?|licen[cs]es?|"
    r"patents?|statements?|also|like|permission|those|treaty|are|if|doctrines|and|or|in|is"
)
_COPYRIGHT = (
    r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright\b(?![\s\p{P}]*(?:" + _WORDING + r")\b)|\(c\)(?!\s+(?:you\s+must|under\s+patent)\b)|©)[^\n]*$"
)


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text, blanks trimmed."""
    text = F.regexp_replace(F.lower(text), _COPYRIGHT, "")
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    for old, new in SPELLINGS:
        text = F.replace(text, F.lit(old), F.lit(new))
    return F.transform(F.split(text, "\n"), lambda line: F.trim(line))


def canonical_text(lines: Column) -> Column:
    """A whole text of canonical lines: those with something in them and no title, one blank between."""
    text = F.array_join(F.filter(lines, lambda line: (line != "") & ~line.isin(*TITLES)), " ")
    for old, new in SPELLINGS:  # those over a line's end
        text = F.replace(text, F.lit(old), F.lit(new))
    return text


def known_digests(spark: SparkSession, known=KNOWN + TEXTS, digests=DIGESTS) -> DataFrame:
    """(digest, license, size) of bounded lists of (name, text) and of (name, digest, size)."""
    known, digests = list(known), list(digests)
    if len(known) + len(digests) > MAX_KNOWN:
        raise ValueError(f"{len(known) + len(digests)} licences; the table is broadcast and takes {MAX_KNOWN} at most")
    rows = spark.createDataFrame(known, "license string, text string")
    canon = rows.select("license", canonical_text(canonical_lines(F.col("text"))).alias("canon"))
    stored = spark.createDataFrame(digests, "license string, digest string, size int")
    return (
        canon.where("canon <> ''")
        .select("license", F.sha2("canon", 256).alias("digest"), F.length("canon").alias("size"))
        .unionByName(stored)
        .groupBy("digest", "size")
        .agg(F.min("license").alias("license"))
    )


def scan_licenses(documents: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, whole_license (null: none), notice_licenses (names in order, comma between), n_notices for every row."""
    sizes = [r.size for r in known.select("size").distinct().collect()]  # at most MAX_KNOWN numbers
    texts = documents.select("doc_id", F.xxhash64("text").alias("thash"), canonical_lines(F.coalesce("text", F.lit(""))).alias("lines"))
    units = F.concat(
        F.array(F.struct(F.lit(-1).alias("line"), canonical_text(F.col("lines")).alias("canon"))),
        F.transform("lines", lambda line, i: F.struct(i.alias("line"), line.alias("canon"))),
    )
    found = (
        texts.select("doc_id", "thash", F.explode(units).alias("u"))
        .where(F.length("u.canon").isin(sizes))
        .select("doc_id", "thash", "u.line", F.sha2("u.canon", 256).alias("digest"))
        .join(F.broadcast(known.select("digest", "license")), "digest")
        .groupBy("doc_id", "thash", "line")
        .agg(F.min("license").alias("license"))
        .groupBy("doc_id", "thash")
        .agg(
            F.max(F.when(F.col("line") < 0, F.col("license"))).alias("whole_license"),
            F.array_join(F.sort_array(F.collect_set(F.when(F.col("line") >= 0, F.col("license")))), ",").alias("notices"),
            F.count_if(F.col("line") >= 0).alias("n_found"),
        )
    )
    every = documents.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"))
    return every.join(found, F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("h") == F.col("thash")), "left").select(
        F.col("id").alias("doc_id"),
        "whole_license",
        F.coalesce("notices", F.lit("")).alias("notice_licenses"),
        F.coalesce("n_found", F.lit(0)).cast("long").alias("n_notices"),
    )


def op4_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), known_digests(spark))


def _literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


#: Letters that stand for a copyright mark in licence wording while the lines with marks go; RE2 cannot look ahead.
_KEPT = {"copyright": "\ua7ff", "(c)": "\ua7fe"}


def _sql() -> str:
    """The scan in SQL: the same rules, texts and digests."""
    known = ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b in KNOWN + TEXTS)
    stored = ", ".join(f"({_literal(a)}, {_literal(b)})" for a, b, _ in DIGESTS)
    titles = ", ".join(map(_literal, TITLES))

    def spelled(text: str) -> str:
        for old, new in SPELLINGS:
            text = f"replace({text}, {_literal(old)}, {_literal(new)})"
        return text

    def lines(text: str) -> str:
        blank = r"[\s\x0b]"
        rules = (
            (rf"copyright((?:{blank}|\p{{P}})+(?:{_WORDING.replace(chr(92) + 's', blank)})\b)", _KEPT["copyright"] + r"\1"),
            (rf"\(c\)({blank}+(?:you{blank}+must|under{blank}+patent)\b)", _KEPT["(c)"] + r"\1"),
            (r"(?m)^[^\p{L}\p{N}\n(©]*(?:copyright\b|\(c\)|©)[^\n]*$", ""),
            (_KEPT["copyright"], "copyright"),
            (_KEPT["(c)"], "(c)"),
            (r"[^\p{L}\p{N}\n]+", " "),
        )
        for pattern, by in rules:
            text = f"regexp_replace({text}, {_literal(pattern)}, {_literal(by)}, 'g')"
        return f"list_transform(string_split({spelled(text)}, chr(10)), lambda x: trim(x))"

    whole = spelled(f"array_to_string(list_filter(lines, lambda x: x <> '' and x not in ({titles})), ' ')")
    return f"""
with listed as (select license, {lines('lower(text)')} as lines from (values {known}) as k(license, text)),
canon as (select license, {whole} as canon from listed),
known as (select digest, min(license) as license from (
    select license, sha256(canon) as digest from canon where canon <> '' union all select * from (values {stored}) as s(license, digest)) group by 1),
rows as (select row_number() over () as rid, doc_id, {lines("lower(coalesce(text, ''))")} as lines from documents),
wholes as (select rid, sha256({whole}) as digest from rows where {whole} <> ''),
units as (select rid, unnest(lines) as line from rows),
notices as (select rid, string_agg(distinct license, ',' order by license) as notices, count(*) as n
    from units join known on sha256(line) = digest where line <> '' group by rid)
select d.doc_id, k.license as whole_license, coalesce(n.notices, '') as notice_licenses, coalesce(n.n, 0) as n_notices
from rows d left join wholes w using (rid) left join known k on w.digest = k.digest left join notices n using (rid)
"""


OP4_SQL = _sql()
