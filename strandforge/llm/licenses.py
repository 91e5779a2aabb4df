"""License scans by ordered signature rules, in DataFrame operations alone.

Rules are regular expressions over a text's normalized words (A-Z in lower
case, words joined by one blank). A rule is tried only where its keyword occurs,
and texts without any sign of a license are not normalized at all. Every
match of every rule is a detection with an interval. A detection that
lies within another's interval is suppressed if that one is longer, or as long
with a better (smaller) priority or an earlier rule. What remains gives the
labels; the score is the best remaining rule's.

The scan is a projection: no shuffle, no group, a task for each part of the
input whatever the texts hold.

Defined results: a null or empty text has no words, places or labels, and score
0; first and last word are null without a place; repeated rows count each time;
columns named like a result are replaced.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Phrases and labels of the base.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

_V = "(?: v| version| ver)? ?"
#: Families: label, the name as a regular expression over normalized words, and the word it can't do without.
FAMILIES = [
    ("gpl-1.0", f"(?:gnu )?(?:gpl|general public license){_V}1(?: 0)?", "1"),
    ("gpl-2.0", f"(?:gnu )?(?:gpl|general public license){_V}2(?: 0)?", "2"),
    ("gpl-3.0", f"(?:gnu )?(?:gpl|general public license){_V}3(?: 0)?", "3"),
    ("gpl", "gnu (?:gpl|general public license)", "gnu"),
    ("lgpl-2.0", f"(?:gnu )?(?:lgpl|(?:lesser|library) general public license){_V}2(?: 0)?", "2"),
    ("lgpl-2.1", f"(?:gnu )?(?:lgpl|lesser general public license){_V}2 1", "2 1"),
    ("lgpl-3.0", f"(?:gnu )?(?:lgpl|lesser general public license){_V}3(?: 0)?", "3"),
    ("lgpl", "gnu (?:lgpl|(?:lesser|library) general public license)", "gnu"),
    ("agpl-1.0", f"(?:affero )?(?:agpl|general public license){_V}1(?: 0)?", "affero"),
    ("agpl-3.0", f"(?:gnu )?(?:agpl|affero general public license){_V}3(?: 0)?", "3"),
    ("agpl", "(?:gnu )?affero general public license", "affero"),
    ("gfdl-1.1", f"(?:gnu )?(?:gfdl|free documentation license){_V}1 1", "1 1"),
    ("gfdl-1.2", f"(?:gnu )?(?:gfdl|free documentation license){_V}1 2", "1 2"),
    ("gfdl-1.3", f"(?:gnu )?(?:gfdl|free documentation license){_V}1 3", "1 3"),
    ("gfdl", "gnu free documentation license", "documentation"),
    ("apache-1.0", f"apache(?: software)? license{_V}1(?: 0)?", "apache"),
    ("apache-1.1", f"apache(?: software)? license{_V}1 1", "apache"),
    ("apache-2.0", f"apache(?: software)?(?: license)?{_V}2(?: 0)?", "apache"),
    ("apache", "apache(?: software)? license", "apache"),
    ("mit", "mit(?: x11)? licen[cs]e", "mit"),
    ("mit-0", "mit no attribution(?: license)?", "mit"),
    ("x11", "x11 license", "x11"),
    ("isc", "isc license", "isc"),
    ("bsd-1-clause", "(?:1|one) clause bsd(?: license)?", "bsd"),
    ("bsd-2-clause", "(?:(?:2|two) clause bsd(?: license)?|(?:simplified|freebsd) (?:bsd )?license)", "bsd"),
    ("bsd-3-clause", "(?:(?:3|three) clause bsd(?: license)?|(?:new|modified|revised) bsd(?: license)?)", "bsd"),
    ("bsd-4-clause", "(?:(?:4|four) clause bsd(?: license)?|original bsd(?: license)?)", "bsd"),
    ("0bsd", "zero clause bsd(?: license)?", "bsd"),
    ("bsd", "bsd (?:style )?license", "bsd"),
    ("mpl-1.0", f"(?:mpl|mozilla public license){_V}1(?: 0)?", "1"),
    ("mpl-1.1", f"(?:mpl|mozilla public license){_V}1 1", "1 1"),
    ("mpl-2.0", f"(?:mpl|mozilla public license){_V}2(?: 0)?", "2"),
    ("mpl", "mozilla public license", "mozilla"),
    ("epl-1.0", f"(?:epl|eclipse public license){_V}1(?: 0)?", "1"),
    ("epl-2.0", f"(?:epl|eclipse public license){_V}2(?: 0)?", "2"),
    ("epl", "eclipse public license", "eclipse"),
    ("cddl-1.0", f"(?:cddl|common development and distribution license){_V}1(?: 0)?", "1"),
    ("cddl-1.1", f"(?:cddl|common development and distribution license){_V}1 1", "1 1"),
    ("cddl", "common development and distribution license", "distribution"),
    ("cpl-1.0", f"common public license{_V}1(?: 0)?", "common"),
    ("eupl-1.1", f"(?:eupl|european union public licen[cs]e){_V}1 1", "1 1"),
    ("eupl-1.2", f"(?:eupl|european union public licen[cs]e){_V}1 2", "1 2"),
    ("artistic-1.0", f"artistic license{_V}1(?: 0)?", "artistic"),
    ("artistic-2.0", f"artistic license{_V}2(?: 0)?", "artistic"),
    ("artistic", "artistic license", "artistic"),
    ("zlib", "(?:zlib|zlib libpng) license", "zlib"),
    ("libpng", "libpng license", "libpng"),
    ("bsl-1.0", f"boost software license(?:{_V}1(?: 0)?)?", "boost"),
    ("busl-1.1", f"business source license(?:{_V}1 1)?", "business"),
    ("unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "(?:wtfpl|do what the fuck you want to public license)", "w"),
    ("postgresql", "postgresql license", "postgresql"),
    ("python-2.0", f"(?:psf|python software foundation) license(?:{_V}2(?: 0)?)?", "license"),
    ("php-3.01", f"php license(?:{_V}3 01)?", "php"),
    ("ruby", "ruby license", "ruby"),
    ("openssl", "openssl license", "openssl"),
    ("ofl-1.1", f"(?:sil )?open font license(?:{_V}1 1)?", "font"),
    ("odbl-1.0", f"(?:odbl|open database license)(?:{_V}1(?: 0)?)?", "o"),
    ("pddl-1.0", f"(?:pddl|public domain dedication and license)(?:{_V}1(?: 0)?)?", "pd"),
    ("odc-by-1.0", f"open data commons attribution license(?:{_V}1(?: 0)?)?", "commons"),
    ("ms-pl", "microsoft public license", "microsoft"),
    ("ms-rl", "microsoft reciprocal license", "microsoft"),
    ("upl-1.0", "universal permissive license", "universal"),
    ("ecl-2.0", "educational community license", "educational"),
    ("osl-3.0", f"open software license(?:{_V}3(?: 0)?)?", "software"),
    ("afl-3.0", f"academic free license(?:{_V}3(?: 0)?)?", "academic"),
    ("ncsa", "(?:ncsa|university of illinois) (?:open source )?license", "license"),
    ("sspl-1.0", "server side public license", "server"),
    ("elastic-2.0", f"elastic license{_V}2(?: 0)?", "elastic"),
    ("vim", "vim license", "vim"),
    ("cc0-1.0", "(?:cc0|cc zero|creative commons zero)(?: 1 0)?(?: universal)?", "c"),
    *[
        (f"cc-{code}-{v}.{m}", f"(?:cc {code.replace('-', ' ')}|creative commons {name})(?: license)?(?: international| unported)?(?: license)? {v} {m}(?: international| unported)?(?: license)?", "c")
        for code, name in (
            ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"), ("by-nd", "attribution no ?deriv(?:ative)?s"),
            ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
        )
        for v, m in ((1, 0), (2, 0), (2, 5), (3, 0), (4, 0))
    ],
    *[
        (f"cc-{code}", f"(?:cc {code.replace('-', ' ')}|creative commons {name})", "c")
        for code, name in (
            ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nc", "attribution non ?commercial"), ("by-nd", "attribution no ?deriv(?:ative)?s"),
            ("by-nc-sa", "attribution non ?commercial share ?alike"), ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s"),
        )
    ],
]
#: Ways in which a family is named: priority, score, the text around the name, keyword (None: the family's).
FORMS = [
    (1, 0.95, "(?:licensed|released|distributed|available|published|provided|covered|used|copied|redistributed)(?: only)? (?:under|pursuant to|according to) (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{}", "under"),
    (2, 0.9, "(?:permission|rights|use) (?:is|are) granted (?:under|by) (?:the )?(?:terms of (?:the )?)?{}", "granted"),
    (3, 0.6, "{}", None),
]
#: Rules that name no family: label, priority, score, pattern, keyword.
OTHERS = [
    ("mit", 1, 0.95, "permission is hereby granted free of charge to any person obtaining a copy of this software", "hereby granted"),
    ("isc", 1, 0.95, "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted", "permission to use"),
    ("bsd", 1, 0.95, "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    ("zlib", 1, 0.9, "this software is provided as is without any express or implied warranty in no event will the authors be held liable", "provided as is"),
    ("unlicense", 1, 0.95, "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("wtfpl", 1, 0.9, "you just do what the fuck you want to", "you just do"),
    ("bsl-1.0", 1, 0.9, "permission is hereby granted free of charge to any person or organization obtaining a copy", "hereby granted"),
    ("gpl", 1, 0.9, "this program is free software you can redistribute it and or modify it", "free software"),
    ("gpl-or-later", 2, 0.8, "either version [123](?: [01])? of the license or at your option any later version", "later version"),
    ("public-domain", 3, 0.7, "(?:released|dedicated|placed) (?:in|into|to) the public domain", "public domain"),
    ("public-domain", 4, 0.5, "public domain", "public domain"),
    ("proprietary", 3, 0.7, "all rights reserved", "rights reserved"),
    ("proprietary", 2, 0.8, "(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("spdx", 2, 0.9, "spdx license identifier [0-9a-z]+(?: [0-9a-z]+){0,2}", "spdx"),
    ("cc", 4, 0.5, "creative commons(?: public)? licen[cs]e", "commons"),
    ("unknown-license", 5, 0.3, "(?:licensed|released|distributed) under (?:the |an |a )?(?:terms of )?(?:open source |free |following )?licen[cs]e", "under"),
    ("disclaimer", 6, 0.2, "without (?:any )?warrant(?:y|ies)(?: or conditions)? of any kind", "warrant"),
]
#: A text without any of these has neither a place of the base nor a match of any rule.
SIGN = (
    r"(?i)licen[cs]|public" + GAP + r"domain|rights" + GAP + r"reserved|warrant|cc0|cc" + GAP + "(?:by|zero)|commons|spdx|hereby" + GAP + r"granted|gpl|gfdl|mpl|epl|"
    r"cddl|eupl|wtfpl|odbl|pddl|apache|mit" + GAP + r"no|bsd|proprietary|unencumbered|redistribut|permission|the fuck|later" + GAP + "version|free" + GAP + "software"
)


def rules() -> list[dict]:
    """Every rule in order: id, label, priority, score, keyword, pattern (over the normalized text)."""
    found = [(*o[:3], o[3], o[4]) for o in OTHERS]
    for priority, score, form, keyword in FORMS:
        found += [(label, priority, score, form.replace("{}", f"(?:{name})"), keyword or own) for label, name, own in FAMILIES]
    return [{"id": k, "label": a, "priority": p, "score": s, "keyword": w, "pattern": f" {x}(?= )"} for k, (a, p, s, x, w) in enumerate(found)]


_RULE = "array<struct<id:int,label:string,priority:int,score:double,keyword:string,pattern:string>>"
_BASE_ANY = " (?:" + "|".join(BASE) + ")(?= )"


def normalized(text: Column) -> Column:
    """The words in lower case (A-Z), each after a blank, and a blank at the end."""
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_replace(F.concat(F.lit(" "), lower, F.lit(" ")), GAP, " ")


def _words_before(norm: Column, chars: Column) -> Column:
    """Blanks in the first `chars` characters: the number of the word that starts after the next blank."""
    head = F.substring(norm, F.lit(1), chars)
    return (F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit("")))).cast("long")


def detections(norm: Column) -> Column:
    """All matches of all rules: array of (id, label, priority, score, start, stop), characters of the normalized text."""
    table = F.from_json(F.lit(json.dumps(rules())), _RULE)

    def matches(rule: Column) -> Column:
        found = F.regexp_extract_all(norm, rule["pattern"], F.lit(0))
        gaps = F.split(norm, rule["pattern"], -1)

        def one(text: Column, k: Column) -> Column:
            upto = F.aggregate(F.slice(gaps, F.lit(1), k + 1), F.lit(0), lambda a, x: a + F.length(x)) + F.aggregate(F.slice(found, F.lit(1), k), F.lit(0), lambda a, x: a + F.length(x))
            return F.struct(rule["id"].alias("id"), rule["label"].alias("label"), rule["priority"].alias("priority"), rule["score"].alias("score"), upto.alias("start"), (upto + F.length(text)).alias("stop"))

        return F.transform(found, one)

    gated = F.filter(table, lambda r: F.contains(norm, r["keyword"]))
    return F.flatten(F.transform(gated, matches))


def unsuppressed(found: Column) -> Column:
    """The detections that lie in no better one's interval."""

    def beaten(d: Column, o: Column) -> Column:
        holds = (o["start"] <= d["start"]) & (o["stop"] >= d["stop"])
        longer = (o["stop"] - o["start"]) > (d["stop"] - d["start"])
        better = (o["priority"] < d["priority"]) | ((o["priority"] == d["priority"]) & (o["id"] < d["id"]))
        return holds & (longer | better)

    return F.filter(found, lambda d: ~F.exists(found, lambda o: beaten(d, o)))


def license_scan(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """keep's columns (default: all but the text), n_words, n_base, first_word, last_word, base_labels, labels, score and found.

    found: the detections that remain, with their intervals in words: array of
    (label, priority, score, first_word, last_word).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "found"]
    keep = [c for c in docs.columns if c != "text" and c not in made] if keep is None else keep
    # texts without a sign keep a null here, and every later step passes them by
    step = docs.select(*[F.col(f"`{c}`") for c in keep], F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_words"), F.when(text.rlike(SIGN), normalized(text)).alias("_norm"))
    norm = F.col("_norm")
    step = step.withColumn("n_base", F.coalesce(F.regexp_count(norm, F.lit(_BASE_ANY)), F.lit(0)).cast("long"))
    some = F.col("n_base") > 0
    first = F.when(some, _words_before(norm, F.regexp_instr(norm, F.lit(_BASE_ANY)) - 1))
    last = F.when(some, _words_before(norm, F.length(F.regexp_extract(norm, f"(?s)^(.*){_BASE_ANY}", 1))))
    base = F.array_compact(F.array(*[F.when(F.contains(norm, F.lit(f" {p} ")), F.lit(label)) for p, label in BASE.items()]))
    step = step.select("*", first.alias("first_word"), last.alias("last_word"), F.when(some, base).otherwise(F.array().cast("array<string>")).alias("_base"), F.when(norm.isNotNull(), detections(norm)).alias("_all"))
    step = step.withColumn("_found", F.when(norm.isNotNull(), unsuppressed(F.col("_all"))).otherwise(F.array().cast(step.schema["_all"].dataType)))
    words = F.transform("_found", lambda d: F.struct(d["label"].alias("label"), d["priority"].alias("priority"), d["score"].alias("score"), _words_before(norm, d["start"]).alias("first_word"), (_words_before(norm, d["stop"]) - 1).alias("last_word")))
    labels = F.array_sort(F.array_union(F.col("_base"), F.transform("_found", lambda d: d["label"])))
    score = F.greatest(F.coalesce(F.array_max(F.transform("_found", lambda d: d["score"])), F.lit(0.0)), F.when(some, F.lit(0.6)).otherwise(F.lit(0.0)))
    return step.select(*[F.col(f"`{c}`") for c in keep], "n_words", "n_base", "first_word", "last_word", F.array_join(F.array_sort("_base"), ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), words.alias("found"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.need(common.documents(spark, sf_dir), ["doc_id", "text"])
    return license_scan(docs, ["doc_id"]).drop("found")
