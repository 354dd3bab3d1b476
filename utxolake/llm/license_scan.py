"""Licence detection by canonical digests of entire texts.

A text is brought to one form (letter case, punctuation, copyright lines and equivalent spellings
don't count) and hashed; a hash join finds the known licence with that digest. Units are whole
texts and, for notices inside documents, single lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from utxolake.llm.common import text_or_empty

# Spellings that count as the same, and the one used.
EQUIVALENT = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("emphasised", "emphasized"),
    ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("http", "https"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("maximise", "maximize"), ("modelled", "modeled"),
    ("modelling", "modeling"), ("noncommercial", "non commercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"),
    ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("signalling", "signaling"),
    ("sub license", "sublicense"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
)

_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_WARRANTY = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_BSD_TWO = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n1. Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.\n2. Redistributions in binary form must reproduce the above copyright notice, "
    "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution.\n"
)
# Known licences and notices.
KNOWN = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
     "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
     "persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice "
     "and this permission notice shall be included in all copies or substantial portions of the Software.\n" + _WARRANTY),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.\n"
     'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
     "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
     "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
     "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE "
     "OF THIS SOFTWARE."),
    ("BSD-2-Clause", _BSD_TWO + _BSD_WARRANTY),
    ("BSD-3-Clause", _BSD_TWO + "3. Neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission.\n" + _BSD_WARRANTY),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
     "compliance with the License. You may obtain a copy of the License at\nhttp://www.apache.org/licenses/LICENSE-2.0\n"
     "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
     '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the '
     "specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC0-1.0", "Licensed under CC0 1.0."),
    ("proprietary", "All rights reserved."),
)

_COPYRIGHT = r"(^|\n)[ \t]*(copyright|\(c\)|©)[^\n]*"
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F\x{A0}\x{A9}\x{AE}\x{2010}-\x{2026}]+"


#: First words of known licences that are kept at the driver to pass over other texts.
MOST_HEADS = 10_000


def _plain(text: Column) -> Column:
    """Lower-case words with single blanks between, without copyright lines."""
    out = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ\r", "abcdefghijklmnopqrstuvwxyz\n")
    return F.trim(F.regexp_replace(F.regexp_replace(out, _COPYRIGHT, "\n"), _SEPARATORS, " "))


def _equalised(plain: Column) -> Column:
    out = F.concat(F.lit(" "), F.replace(plain, F.lit(" "), F.lit("  ")), F.lit(" "))  # each word between blanks of its own
    for a, b in EQUIVALENT:
        out = F.replace(out, F.lit(f" {a.replace(' ', '  ')} "), F.lit(f" {b.replace(' ', '  ')} "))
    return out


def canonical(text: Column) -> Column:
    """The form that equal licences share; ``canonical_sql`` states it for DuckDB."""
    return _equalised(_plain(text))


def digest(text: Column) -> Column:
    return F.sha2(canonical(text).cast("binary"), 256)


def _head(plain: Column) -> Column:
    """The canonical form's first word: spellings of two words at most count as the same, so two words tell it."""
    return F.substring_index(F.trim(_equalised(F.substring_index(plain, " ", 2))), " ", 1)


def known_licenses(spark: SparkSession, known: tuple = KNOWN) -> DataFrame:
    """(license_id, text) of the licences listed here."""
    rows = F.array(*[F.struct(F.lit(i).alias("license_id"), F.lit(t).alias("text")) for i, t in known])
    return spark.range(1).select(F.inline(rows))


def scan(docs: DataFrame, licenses: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, license_id (of the entire text; null if unknown), n_notices (known licences among the
    text's lines) and notices (their ids, sorted, joined by commas).

    ``licenses`` has license_id and text; of licences with one digest the smallest id counts, and a canonical form without
    words is no licence. Texts and lines that begin with no known licence's first word aren't hashed. Null texts count as
    empty. Rows with equal or null ids are judged each on its own; extra columns are ignored; an empty table gives no rows.
    """
    known = licenses.select(F.col("license_id").cast("string").alias("license_id"), _plain(text_or_empty(F.col("text"))).alias("plain")).where("plain <> ''")
    heads = [r[0] for r in known.select(_head(F.col("plain"))).distinct().limit(MOST_HEADS + 1).collect()]
    likely = _head(F.col("plain")).isin(heads) if len(heads) <= MOST_HEADS else F.lit(True)
    hashed = F.sha2(_equalised(F.col("plain")).cast("binary"), 256).alias("digest")
    known = known.groupBy(hashed).agg(F.min("license_id").alias("license_id"))
    text = text_or_empty(F.col(text_col))
    key = [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("second"), text).alias("t2")]
    whole = docs.select(*key, F.lit(True).alias("whole"), _plain(text).alias("plain"))
    lines = docs.select(*key, F.lit(False).alias("whole"), F.explode(F.split(F.translate(text, "\r", "\n"), "\n")).alias("line"))
    lines = lines.select("t1", "t2", "whole", _plain(F.col("line")).alias("plain"))
    units = whole.unionByName(lines).where(likely).select("t1", "t2", "whole", hashed)  # joined on digests: no text is shuffled
    found = units.join(known, "digest").groupBy("t1", "t2").agg(
        F.min(F.when(F.col("whole"), F.col("license_id"))).alias("license_id"),
        F.sort_array(F.collect_set(F.when(~F.col("whole"), F.col("license_id")))).alias("ids"))
    out = docs.select(F.col(id_col).alias("id"), *key).join(found, ["t1", "t2"], "left")
    return out.select(
        F.col("id").alias(id_col), "license_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_notices"),
        F.coalesce(F.array_join("ids", ","), F.lit("")).alias("notices"),
    )


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def canonical_sql(text: str) -> str:
    out = f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(13), 'abcdefghijklmnopqrstuvwxyz' || chr(10))"
    out = f"regexp_replace({out}, {_quoted(_COPYRIGHT)}, chr(10), 'g')"
    out = f"trim(regexp_replace({out}, {_quoted(_SEPARATORS)}, ' ', 'g'))"
    out = f"' ' || replace({out}, ' ', '  ') || ' '"
    for a, b in EQUIVALENT:
        out = f"replace({out}, {_quoted(' ' + a.replace(' ', '  ') + ' ')}, {_quoted(' ' + b.replace(' ', '  ') + ' ')})"
    return out


def scan_sql(known: tuple = KNOWN) -> str:
    """DuckDB SQL of the scan of ``documents`` for the licences listed here."""
    values = ", ".join(f"({_quoted(i)}, {_quoted(t)})" for i, t in known)
    return f"""
WITH listed(license_id, text) AS (VALUES {values}),
known AS (SELECT sha256({canonical_sql("text")}) AS digest, min(license_id) AS license_id FROM listed GROUP BY 1),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (SELECT r, unnest(string_split(replace(text, chr(13), chr(10)), chr(10))) AS line FROM docs),
found AS (
  SELECT r, list_sort(list_distinct(list(license_id))) AS ids
  FROM (SELECT r, sha256({canonical_sql("line")}) AS digest FROM lines WHERE line <> '') JOIN known USING (digest) GROUP BY r
), whole AS (SELECT r, doc_id, sha256({canonical_sql("text")}) AS text_digest FROM docs)
SELECT w.doc_id, k.license_id, CAST(coalesce(len(f.ids), 0) AS BIGINT) AS n_notices, coalesce(array_to_string(f.ids, ','), '') AS notices
FROM whole w LEFT JOIN found f USING (r) LEFT JOIN known k ON k.digest = w.text_digest
"""
