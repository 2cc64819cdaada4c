"""License scans in DataFrame functions: headers and licence files by TF-IDF cosine, then inheritance by directory.

Terms are taken across line breaks. Around every cue, the window that a header would fill there is compared with that
header; the whole term vector of a file with a cue is compared with full licence texts. Both are sparse TF-IDF vectors.
What distinguishes licences (versions, SA, NC, ND, Lesser, ...) must agree exactly. A file whose text is mostly licence is
the licence file of its directory; any other file with one has a licence of its own. A file without takes that of the
licence file in the nearest ancestor directory, found by a join of paths. Only windows, terms of files with a cue,
directories and narrow paths are shuffled.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from importlib.resources import files as package_files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablespoon.session import stored

#: Short forms of common licence notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2.0"),
    ("mit", "released under the mit license"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3"),
    ("bsd-3-clause", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4.0"),
    ("cc-by-4.0", "this work is licensed under a creative commons attribution 4.0 international license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2.0"),
)
CUE = r"licen[sc]e|copyright|spdx|redistribution and use|public domain"
LEAST_COSINE = 0.6
FILE_SHARE = 0.5  # of a file's words that its licence words must have for it to be a licence file
WORD = r"[a-z0-9]+(?:\.[0-9]+)*"
#: Besides CUE, what a header or a full text can be known by.
MORE_CUES = r"redistribution\W+and\W+use|public\W+domain|permission\W+(?:is\W+hereby|to\W+use)|as.is\b|creative\W*commons|\bcc\W+by\b|general\W+public"
_JOINED = ((r"non\W+commercial", "noncommercial"), (r"share\W+alike", "sharealike"), (r"no\W+deriv", "noderiv"))
_ANCHOR = r"licen[sc]e[sd]?|unlicense|copyright|spdx|redistribution|domain|permission|creativecommons|creative|cc"
_TAGS = {
    "sa": "sa", "sharealike": "sa", "nc": "nc", "noncommercial": "nc", "nd": "nd", "noderivatives": "nd", "noderivs": "nd",
    "lesser": "lesser", "library": "library", "affero": "affero",
}
_VERSION = r"v?([0-9](?:\.[0-9])?)"


def _headers() -> list[tuple[str, str]]:
    out = []
    gnu = (("gpl", "", ("1", "2", "3")), ("lgpl", "library ", ("2",)), ("lgpl", "lesser ", ("2.1", "3")), ("agpl", "affero ", ("3",)))
    for short, kind, versions in gnu:
        for v in versions:
            name, full = f"{short}-{v if '.' in v else v + '.0'}", f"gnu {kind}general public license"
            for n in {v, name.rsplit("-", 1)[1]}:
                out += [(name, f"{full} {x}") for x in (f"version {n}", f"v {n}", f"v{n}", n)]
                out += [(name, f"version {n} of the {full}"), (name, f"version {n} of {full}")]
                out += [(name, f"{full} as published by the free software foundation {x}version {n}") for x in ("", "either ")]
                out += [(name, f"licensed under {x}{short}{y}") for x in ("", "the ") for y in (f" {n}", f" v{n}", f"v{n}", f" version {n}")]
    public = (("apache", "apache", ("1.1", "2.0")), ("mpl", "mozilla public", ("1.0", "1.1", "2.0")), ("epl", "eclipse public", ("1.0", "2.0")),
              ("bsl", "boost software", ("1.0",)), ("artistic", "artistic", ("1.0", "2.0")))
    for short, full, versions in public:
        for v in versions:
            out += [(f"{short}-{v}", f"{full} license {x}{v}") for x in ("version ", "v ", "v", "")]
            out += [(f"{short}-{v}", f"{full} license {v[0]}")] if v.endswith(".0") else []
            out += [(f"{short}-{v}", f"{short} {v} license")]
    for v in ("2", "3"):
        out += [(f"bsd-{v}-clause", x) for x in (f"bsd {v} clause license", f"{v} clause bsd license")]
    out += [(n, f"{n} license") for n in ("mit", "isc", "zlib", "0bsd")]
    out += [("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
            ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
            ("unlicense", "free and unencumbered software released into the public domain"), ("cc0-1.0", "cc0 1.0 universal license"),
            ("cc0-1.0", "creative commons zero 1.0"), ("cc0-1.0", "creativecommons org publicdomain zero 1.0")]
    for short, long in (("", ""), ("sa ", "sharealike "), ("nc ", "noncommercial "), ("nd ", "noderivatives "),
                        ("nc sa ", "noncommercial sharealike "), ("nc nd ", "noncommercial noderivatives ")):
        for v in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            name = f"cc by {short}{v}".replace(" ", "-")
            out += [(name, x) for x in (f"cc by {short}{v}", f"creativecommons org licenses by {short}{v}", f"creative commons attribution {long}{v}")]
            out += [(name, f"creative commons attribution {long}{x}") for x in (f"license {v}", f"license version {v}", f"version {v}")]
            out += [(name, f"creative commons attribution {long}{v} {x} license") for x in ("international", "unported", "generic")]
            if "noderivatives" in long:
                out += [(name, f"creative commons attribution {long.replace('noderivatives', 'noderivs')}{v}")]
    names = sorted({n for n, _ in out})
    out += [(n, f"spdx license identifier {n.replace('-', ' ')}") for n in names]
    return out


HEADERS = tuple(_headers())
#: (licence, file of the full text, words it must hold, words it must not hold). The AGPL differs from the GPL in one section.
TEXTS = (
    ("apache-2.0", "apache-2.0", "apache license version 2.0", ""),
    ("gpl-1.0", "gpl-1.0", "gnu general public license version 1", ""),
    ("gpl-2.0", "gpl-2.0", "gnu general public license version 2", ""),
    ("gpl-3.0", "gpl-3.0", "gnu general public license version 3", "gnu affero general public license version 3 19"),
    ("agpl-3.0", "gpl-3.0", "gnu affero general public license version 3", ""),
    ("lgpl-2.0", "lgpl-2.0", "gnu library general public license version 2", ""),
    ("lgpl-2.1", "lgpl-2.1", "gnu lesser general public license version 2.1", ""),
    ("lgpl-3.0", "lgpl-3.0", "gnu lesser general public license version 3", ""),
    ("mpl-1.1", "mpl-1.1", "mozilla public license version 1.1", ""),
    ("mpl-2.0", "mpl-2.0", "mozilla public license version 2.0", ""),
    ("cc0-1.0", "cc0-1.0", "cc0 1.0 universal", ""),
    ("artistic-1.0", "artistic-1.0", "artistic license", "artistic license 2.0"),
    ("bsd-2-clause", "bsd-2-clause", "redistribution and use in source and binary forms", "endorse or promote"),
    ("bsd-3-clause", "bsd-3-clause", "endorse or promote", "all advertising materials"),
    ("mit", "mit", "permission is hereby granted free of charge", ""),
    ("isc", "isc", "provided that the above copyright notice", ""),
    ("0bsd", "0bsd", "with or without fee is hereby granted", "provided that the above copyright notice"),
    ("zlib", "zlib", "altered source versions must be plainly marked", ""),
    ("unlicense", "unlicense", "free and unencumbered software", ""),
    ("bsl-1.0", "bsl-1.0", "boost software license version 1.0", ""),
)


def _terms(line: Column) -> Column:
    return F.regexp_extract_all(F.lower(line), F.lit(f"({WORD})"), F.lit(1))


def _joined_terms(text: Column) -> Column:
    """Terms of a whole text, with words such as ``Non-Commercial`` in one."""
    body = F.lower(text)
    for pattern, word in _JOINED:
        body = F.regexp_replace(body, pattern, word)
    return _terms(body)


def _plain_terms(text: str) -> list[str]:
    body = text.lower()
    for pattern, word in _JOINED:
        body = re.sub(pattern, word, body)
    return re.findall(WORD, body)


def _mark(term: str) -> str | None:
    """What ``term`` distinguishes, versions without ``v`` and ``.0``."""
    version = re.fullmatch(_VERSION, term)
    return version[1].removesuffix(".0") if version else _TAGS.get(term)


def _marks(terms: Column) -> Column:
    """As :func:`_mark`, of all terms of an array, as one string."""
    tags = F.create_map(*(F.lit(x) for pair in _TAGS.items() for x in pair))
    one = lambda t: F.when(
        t.rlike(f"^{_VERSION}$"), F.regexp_replace(F.regexp_replace(t, "^v", ""), r"\.0$", "")
    ).otherwise(F.try_element_at(tags, t))
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.transform(terms, one)))), " ")


def _vectors(bodies: list[list[str]]) -> tuple[dict[str, float], list[dict[str, float]]]:
    """(idf, unit vectors), idf being ln(1 + bodies / bodies with the term)."""
    seen = Counter(t for b in bodies for t in set(b))
    idf = {t: math.log1p(len(bodies) / n) for t, n in seen.items()}
    out = []
    for b in bodies:
        weights = {t: n * idf[t] for t, n in Counter(b).items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        out.append({t: w / norm for t, w in weights.items()})
    return idf, out


def _exact(value: Column) -> Column:
    return F.sum(value.cast("decimal(38,12)")).cast("double")


def _norms(terms: DataFrame, key: str, idf: dict[str, float], bodies: int) -> tuple[DataFrame, DataFrame]:
    """(weights, norms) of (key, term, tf); a term that no body has counts with the largest idf."""
    known = terms.sparkSession.createDataFrame(list(idf.items()), "term string, idf double")
    weights = terms.join(F.broadcast(known), "term", "left").withColumn("w", F.col("tf") * F.coalesce("idf", F.log1p(F.lit(float(bodies)))))
    return weights, weights.groupBy(key).agg(F.sqrt(_exact(F.col("w") * F.col("w"))).alias("norm"))


def cued_files(files: DataFrame, path: str, text: str) -> DataFrame:
    """(row, path, terms) of rows whose text has a cue."""
    body = F.coalesce(F.col(text), F.lit(""))
    cued = files.where(F.lower(body).rlike(f"{CUE}|{MORE_CUES}")).select(F.col(path).alias("path"), _joined_terms(body).alias("terms"))
    return stored(cued.withColumn("row", F.monotonically_increasing_id()), "cued")


def licence_windows(cued: DataFrame, headers) -> DataFrame:
    """(row, licence, cosine, begin, size) of the best header around every cue that is close enough to one."""
    bodies = [_plain_terms(body) for _, body in headers]
    idf, vectors = _vectors(bodies)
    fits: dict[str, dict[tuple, list[int]]] = {}
    for i, body in enumerate(bodies):
        marks = " ".join(sorted({m for m in map(_mark, body) if m}))
        # every cue of a header can be the one that is found
        for at, term in enumerate(body):
            if re.fullmatch(_ANCHOR, term):
                for same in {term, term.replace("license", "licence")}:
                    fits.setdefault(same, {}).setdefault((at, len(body), marks), []).append(i)
    spark = cued.sparkSession
    places = spark.createDataFrame(
        [(t, [(at, n, m, ids) for (at, n, m), ids in some.items()]) for t, some in fits.items()],
        "cue string, fits array<struct<at:int,n:int,marks:string,ids:array<int>>>",
    )
    # around a cue the terms that the longest header can reach, and where they begin in the file
    reach = max(map(len, bodies))
    around = F.transform(
        F.filter(F.transform("terms", lambda t, i: F.struct(t.alias("cue"), i.alias("i"))), lambda x: x.cue.isin(*fits)),
        lambda x: F.struct(
            x.cue.alias("cue"), x.i.alias("i"), F.least(x.i, F.lit(reach)).alias("before"),
            F.slice("terms", F.greatest(x.i - reach, F.lit(0)) + 1, 2 * reach).alias("near"),
        ),
    )
    words = F.concat(F.lit(" "), F.array_join("terms", " "), F.lit(" "))
    flags = [F.instr(words, f" {x} ").cast("boolean").alias(n) for x, n in (("endorse or promote", "endorse"), ("following disclaimer", "disclaimer"))]
    cues = cued.select("row", *flags, F.explode(around).alias("a")).select("row", "endorse", "disclaimer", "a.*")
    tried = cues.join(F.broadcast(places), "cue").select("*", F.explode("fits").alias("f")).where("before >= f.at")
    tried = tried.withColumn("body", F.slice("near", F.col("before") - F.col("f.at") + 1, F.col("f.n")))
    tried = tried.where(_marks(F.col("body")) == F.col("f.marks")).select(
        "row", "endorse", "disclaimer", "i", (F.col("i") - F.col("f.at")).alias("begin"), F.size("body").alias("size"),
        F.array_join("body", " ").alias("body"), "f.ids",
    )
    tried = stored(tried, "windows")
    distinct = tried.select("body", F.explode("ids").alias("id")).distinct()
    terms = distinct.select("body").distinct().select("body", F.explode(F.split("body", " ")).alias("term"))
    weights, norms = _norms(terms.groupBy("body", "term").agg(F.count("*").alias("tf")), "body", idf, len(bodies))
    shares = spark.createDataFrame([(i, t, s) for i, v in enumerate(vectors) for t, s in v.items()], "id int, term string, share double")
    named = spark.createDataFrame([(i, n, b.startswith("redistribution")) for i, (n, b) in enumerate(headers)], "id int, licence string, sentence boolean")
    dots = weights.select("body", "term", "w").join(distinct, "body").join(F.broadcast(shares), ["id", "term"]).groupBy("body", "id").agg(
        _exact(F.col("w") * F.col("share")).alias("dot")
    )
    near = dots.join(norms, "body").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= LEAST_COSINE)
    near = stored(near.join(F.broadcast(named), "id").select("body", "id", "licence", "sentence", "cosine"), "near")
    hits = tried.withColumn("id", F.explode("ids")).join(near, ["body", "id"])
    # the sentence that all BSD licences begin with names none of them
    licence = F.when(~F.col("sentence") | F.col("endorse"), F.col("licence")).when(F.col("disclaimer"), F.lit("bsd-2-clause"))
    hits = hits.withColumn("licence", licence).where("licence IS NOT NULL")
    order = F.struct((-F.col("cosine")).alias("c"), (-F.col("size")).alias("s"), "licence", "begin")
    best = hits.groupBy("row", "i").agg(F.min_by(F.struct("licence", "cosine", "begin", "size"), order).alias("b"))
    return best.select("row", "b.*")


def licence_texts(cued: DataFrame, texts=TEXTS) -> DataFrame:
    """(row, licence, cosine, covered) of the closest full text of each file; ``covered`` terms of the file are in it."""
    folder = package_files("tablespoon.llm") / "licence_texts"
    bodies = [_plain_terms((folder / f"{file}.txt").read_text(encoding="utf-8")) for _, file, _, _ in texts]
    idf, vectors = _vectors(bodies)
    spark = cued.sparkSession
    terms = cued.select("row", F.explode("terms").alias("term")).groupBy("row", "term").agg(F.count("*").alias("tf"))
    weights, norms = _norms(terms, "row", idf, len(bodies))
    shares = spark.createDataFrame(
        [(i, t, s, c[t]) for i, (v, b) in enumerate(zip(vectors, bodies)) for c in [Counter(b)] for t, s in v.items()],
        "id int, term string, share double, most int",
    )
    dots = weights.join(F.broadcast(shares), "term").groupBy("row", "id").agg(
        _exact(F.col("w") * F.col("share")).alias("dot"), F.sum(F.least("tf", "most")).alias("covered")
    )
    near = dots.join(norms, "row").withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 6)).where(F.col("cosine") >= LEAST_COSINE)
    demands = spark.createDataFrame([(i, t[0], t[2], t[3]) for i, t in enumerate(texts)], "id int, licence string, has string, lacks string")
    words = F.concat(F.lit(" "), F.array_join("terms", " "), F.lit(" "))
    holds = lambda c: F.expr(f"contains(words, concat(' ', {c}, ' '))")
    near = near.join(F.broadcast(demands), "id").join(cued.select("row", words.alias("words")), "row")
    near = near.where(holds("has") & ((F.col("lacks") == "") | ~holds("lacks")))
    best = near.groupBy("row").agg(F.min_by(F.struct("licence", "cosine", "covered"), F.struct((-F.col("cosine")).alias("c"), "licence")).alias("b"))
    return best.select("row", "b.*")


def own_licences(files: DataFrame, path: str = "path", text: str = "text", headers=(*TEMPLATES, *HEADERS), texts=TEXTS) -> DataFrame:
    """(path, licence, cosine, licence_words) of every file with a licence in it; a text that is mostly a full one is that."""
    cued = cued_files(files, path, text)
    ranges = F.transform(F.collect_list(F.struct("begin", "size")), lambda x: F.sequence(x.begin, x.begin + x.size - 1))
    windows = licence_windows(cued, headers).groupBy("row").agg(
        F.min_by(F.struct("licence", "cosine"), F.struct((-F.col("cosine")).alias("c"), (-F.col("size")).alias("s"), "licence")).alias("b"),
        F.size(F.array_distinct(F.flatten(ranges))).cast("long").alias("covered"),
    )
    sized = cued.select("row", F.size("terms").alias("n"))
    whole = licence_texts(cued, texts).join(sized, "row").withColumn("main", F.col("covered") >= F.col("n") * FILE_SHARE)
    found = windows.select("row", "b.*", "covered", F.lit(False).alias("main")).unionByName(
        whole.select("row", "licence", "cosine", "covered", "main")
    )
    order = F.struct((~F.col("main")).alias("m"), (-F.col("cosine")).alias("c"), "licence")
    rows = found.groupBy("row").agg(F.min_by(F.struct("main", "licence", "cosine"), order).alias("b"), F.max("covered").alias("covered"))
    rows = rows.join(cued.select("row", "path").where("path IS NOT NULL"), "row").select("path", "b.*", "covered")
    return rows.groupBy("path").agg(F.min_by(F.struct("licence", "cosine"), order).alias("b"), F.sum("covered").alias("licence_words")).select(
        "path", "b.*", "licence_words"
    )


def scan_licences(files: DataFrame, path: str = "path", text: str = "text", headers=(*TEMPLATES, *HEADERS), texts=TEXTS) -> DataFrame:
    """(path, licence, cosine, origin, source_path) of every row of ``files``.

    ``origin`` is ``own`` (a header in the file, or the file is a licence file), ``inherited`` (from the licence file
    of the nearest ancestor directory, its own directory first) or ``none``; ``source_path`` is the file it comes from. Of
    several licences in a file, or licence files in a directory, the closest to its template counts, then the first by
    name. Null and empty texts have no licence of their own; a null path inherits nothing; rows that share a path are one
    file for the licence (the closest counts), and each is returned.
    """
    words = F.size(_terms(F.coalesce(F.col(text), F.lit(""))))
    own = stored(own_licences(files, path, text, headers, texts), "own")
    with_own = files.select(F.col(path).alias("path"), F.col(text).alias(text)).join(own, "path", "left_semi")
    counts = with_own.groupBy("path").agg(F.sum(words).alias("words"))
    of_directory = own.join(counts, "path").where(F.col("licence_words") >= F.col("words") * FILE_SHARE)
    directory = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    of_directory = of_directory.groupBy(directory.alias("directory")).agg(
        F.min_by(F.struct("licence", "cosine", "path"), F.struct((-F.col("cosine")).alias("c"), "path")).alias("d")
    )
    of_directory = stored(of_directory, "directories")
    rows = files.select(F.col(path).alias("path"))
    bare = rows.where("path IS NOT NULL").distinct().join(own, "path", "left_anti")
    parts = F.split("path", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    climbed = bare.select("path", F.explode(above).alias("directory")).join(of_directory, "directory")
    nearest = climbed.groupBy("path").agg(F.max_by("d", F.length("directory")).alias("d"))
    decided = own.select("path", "licence", "cosine", F.lit("own").alias("origin"), F.col("path").alias("source_path")).unionByName(
        nearest.select("path", "d.licence", "d.cosine", F.lit("inherited").alias("origin"), F.col("d.path").alias("source_path"))
    )
    return rows.join(decided, "path", "left").withColumn("origin", F.coalesce("origin", F.lit("none")))


def digit_path(source: str, lang: str, key: str) -> Column:
    """A path for tables without one: source, language, one directory per digit of the key but the last, then the key."""
    digits = F.col(key).cast("string")
    middle = F.regexp_replace(F.substring(digits, F.lit(1), F.length(digits) - 1), r"(.)", "$1/")
    part = lambda c: F.coalesce(F.col(c), F.lit("-"))
    return F.concat(part(source), F.lit("/"), part(lang), F.lit("/"), middle, digits)
