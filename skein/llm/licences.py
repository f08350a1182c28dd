"""Licence scan: whole texts and their notice lines, normalised and looked up by digest. Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that mean the same, applied in this order to lower-case text.
SPELLINGS = (
    ("licence", "license"), ("favour", "favor"), ("honour", "honor"), ("behaviour", "behavior"), ("organisation", "organization"),
    ("authorise", "authorize"), ("merchantibility", "merchantability"), ("noninfringement", "non infringement"), ("sub license", "sublicense"),
    ("sub-license", "sublicense"), ("non-commercial", "noncommercial"), ("per cent", "percent"), ("acknowledgement", "acknowledgment"), ("http://", "https://"),
)
COPYRIGHT_LINE = r"(^|\n)[^a-z0-9\n]*(copyright|\(c\)|©)[^\n]*"
RIGHTS = "all rights reserved"
OTHER = r"[^a-z0-9\x{80}-\x{10FFFF}]+"
#: Lines that may be notices; the digest decides.
NOTICE_LINE = "licen|public domain|spdx|copyleft"

_PERMISSION = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_TAIL = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""
_GPL3 = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.

You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

#: (licence id, text): a fixed registry; the join may broadcast it.
KNOWN = (
    ("MIT", _PERMISSION), ("MIT", "MIT License\n\n" + _PERMISSION), ("MIT", "The MIT License (MIT)\n\n" + _PERMISSION),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", _ISC), ("ISC", "ISC License\n\n" + _ISC), ("Apache-2.0", _APACHE), ("GPL-3.0", _GPL3), ("Zlib", _ZLIB), ("Zlib", "zlib License\n\n" + _ZLIB), ("Unlicense", _UNLICENSE), ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org/>"),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-4.0", "This work is licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC0-1.0", "This work is in the public domain."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
)


#: (licence id, digest of the normalised text) of long licences: as published, and without and with the closing line where an appendix follows.
KNOWN_DIGESTS = (
    ("Apache-2.0", "cc411e5c73676ae13e68bf0fe2c031a62b3a1ef56829577a7d168699686c1e7e"),
    ("Apache-2.0", "f16a2c71cdef52763eb4e8d07430ba72c05356a4e2204a12f3995c1ee5d38fde"),
    ("Apache-2.0", "bb9623a3f15021216105e0ed4e2426d8ef8863d7c5f58860ef1cd2bf983015cf"),
    ("Artistic-1.0-Perl", "93aa47d57763801ed6e6a6591d4d4049a2c46794df90838023ceade56b569da0"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "835e93c269f96ffb287b3c8c1c5d41482a48fe84971237b192ae3d0f85299142"),
    ("GFDL-1.3", "2d23a1792689607291f114da9fdb3b413c6ef2346dfb9e4fafe0c5cf9b969da3"),
    ("GPL-1.0", "9e12a40a9b22c45d116f19e1746b08ea0b853519de3e03ceb780f2a36d5f388c"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "b866f5427b78991db8012466b32f51c907f5e974fde5129a47372d0d0552e3a1"),
    ("GPL-2.0", "a1e7ba14d8d85807f384435b77f91e925decc43da128311c991c4f2337e44017"),
    ("GPL-2.0", "e4d14510e41435c3eb12c255b72546a3cb9943f06f209c72bc30a19095b08999"),
    ("GPL-3.0", "5272fb2d9117cba4ebb1b4a6612e61ab05ddddeff56bd30c3ac3798e23821b30"),
    ("GPL-3.0", "f37d587507fc579524cb06d1130d5899891a978ee008cfc033b3b4d95da28bee"),
    ("GPL-3.0", "f7bb29d9a31c3a1a68ccff0d8d9053350dc0b10b52b62d46d0f2e36a41e32975"),
    ("LGPL-2.0", "b4114daa3dfa52e27e78b2c4e17acd58bf4381e812762f4ded0bcb8eabd1092c"),
    ("LGPL-2.0", "e0de5033b5ad2a24c0a1a8b04f09e33038ffa62d2bef7178de2a3c6f5d56f499"),
    ("LGPL-2.0", "ff773d8d898dfc51ae2dbf3baa20700673e8ceb153b13d26c525af34a59adf0c"),
    ("LGPL-2.1", "294fb9ec58649c7eb0cf90fc2900ac1b28b82fb6da9d40d7599d6b7d399d4d2e"),
    ("LGPL-2.1", "9bf9c99aeafbdbccd7456a00d574699e3deb41868375496cacbf170be719bebd"),
    ("LGPL-2.1", "963f79d48038eed98d8341c84d8d3b765e99508a738d00654c0112f70a7c370c"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "3dacd2c104719e7227969cbdcc7d581518827199e830b9379627eec0a32f8ab7"),
)


def normalised(text: Column) -> Column:
    """Lower case, no copyright lines, one spelling, and words of letters and digits with one space between."""
    t = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "\n")
    for a, b in SPELLINGS:
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(F.replace(t, F.lit(RIGHTS), F.lit("")), OTHER, " "))


def digest(text: Column) -> Column:
    return F.sha2(normalised(text), 256)


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN, digests: tuple[tuple[str, str], ...] = KNOWN_DIGESTS) -> DataFrame:
    """(licence, known_digest), each digest once: of the texts, and those given as such."""
    rows = spark.createDataFrame(list(known), "licence string, text string").select(digest(F.col("text")).alias("known_digest"), "licence")
    given = spark.createDataFrame(list(digests), "licence string, known_digest string").select("known_digest", "licence")
    return rows.unionByName(given).groupBy("known_digest").agg(F.min("licence").alias("licence"))


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """One row for each input row: (doc_id long, text_digest string, text_licence string, notice_licences string).

    text_licence is the known licence that the whole text is, or null; notice_licences lists, sorted
    and comma-separated, those that single lines are ('' if none). One projection and a join with the
    registry, whose size is fixed in code; texts are never shuffled. Null texts count as empty; null
    ids and repeated rows stay; extra columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    registry = known_digests(spark, known)
    pairs = registry.collect()  # as many rows as the registry has texts
    lookup = F.create_map(*(F.lit(x) for r in pairs for x in (r.known_digest, r.licence)))
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # a line that may be a notice is rare, so its digest is taken line by line and only where one is
    lines = F.filter(F.split(body, "\n"), lambda x: F.lower(x).rlike(NOTICE_LINE))
    found = F.filter(F.transform(lines, lambda x: F.try_element_at(lookup, digest(x))), lambda x: x.isNotNull())
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), digest(body).alias("text_digest"), F.array_join(F.array_sort(F.array_distinct(found)), ",").alias("notice_licences"))
    joined = rows.join(F.broadcast(registry), rows["text_digest"] == registry["known_digest"], "left")
    return joined.select("doc_id", "text_digest", F.col("licence").alias("text_licence"), "notice_licences")


def _sql_normalised(text: str) -> str:
    q = lambda s: "'" + s.replace("'", "''") + "'"
    t = f"regexp_replace(lower({text}), {q(COPYRIGHT_LINE)}, chr(10), 'g')"
    for a, b in (*SPELLINGS, (RIGHTS, "")):
        t = f"replace({t}, {q(a)}, {q(b)})"
    return f"trim(regexp_replace({t}, {q(OTHER)}, ' ', 'g'))"


def oracle_sql(known: tuple[tuple[str, str], ...] = KNOWN) -> str:
    """The same scan for DuckDB."""
    values = ", ".join("('" + a + "', '" + b.replace("'", "''") + "')" for a, b in known)
    given = ", ".join(f"('{a}', '{b}')" for a, b in KNOWN_DIGESTS)
    return f"""
with registry as (select known_digest, min(licence) as licence from (
  select sha256({_sql_normalised("body")}) as known_digest, licence from (values {values}) k(licence, body)
  union all select known_digest, licence from (values {given}) g(licence, known_digest)) group by 1),
docs as (select row_number() over () as rn, doc_id, coalesce(text, '') as body from documents),
lines as (select rn, unnest(string_split(body, chr(10))) as line from docs),
notices as (select rn, string_agg(distinct licence, ',' order by licence) as found from lines
  join registry on sha256({_sql_normalised("line")}) = known_digest where regexp_matches(lower(line), '{NOTICE_LINE}') group by rn)
select doc_id, sha256({_sql_normalised("body")}) as text_digest, r.licence as text_licence, coalesce(n.found, '') as notice_licences
from docs d left join registry r on sha256({_sql_normalised("d.body")}) = r.known_digest left join notices n on n.rn = d.rn"""
