"""License scans: ordered signature rules on normalised words, gated by keywords, native.

A text becomes its words, lower-cased and separated by single spaces, so that a rule is a pattern over words.
There are rules for sentences of the licenses themselves and of the notices that stand in files, each written by hand,
and rules for the forms in which a license is named: SPDX tags, addresses, grants, titles, bare names. A text is
searched by a rule only if it has a keyword of the gate and the rule's own keywords. Where places overlap, one inside
another of the same or a higher priority is suppressed. No Python runs on the executors.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.llm._native import CLOSE, OPEN, folded, let

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# The base phrases and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

# Label, keywords of which every use of the name has one, the name's pattern, the SPDX tag's pattern, the address's pattern.
NAMES = (
    ("mit", "mit", "mit", "mit", "opensource org licenses mit"),
    ("mit-0", "mit", "mit (no attribution|0)", "mit 0", "opensource org licenses? mit 0"),
    ("apache-2", "apache", "apache( software)?( license)?( version| v)? ?2( 0)?", "apache 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "apache", "apache( software)?( license)?( version| v)? ?1 1", "apache 1 1", "apache org licenses license 1 1"),
    ("apache-1", "apache", "apache( software)?( license)?( version| v)? ?1( 0)?(?! 1)", "apache 1 0", "apache org licenses license 1 0"),
    ("bsd-2-clause", "bsd|freebsd|simplified bsd", "(simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)", "bsd 2 clause", "opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)", "bsd 3 clause", "opensource org licenses bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(original bsd|bsd 4 clause|4 clause bsd|four clause bsd)", "bsd 4 clause", "spdx org licenses bsd 4 clause"),
    ("0bsd", "bsd|0bsd|zero clause|0 clause", "(zero clause bsd|bsd zero clause|0 clause bsd|0bsd)", "0bsd", "opensource org licenses 0bsd"),
    ("isc", "isc", "isc", "isc", "opensource org licenses isc"),
    ("gpl-1", "general public licen|gpl", "(gnu )?(general public license|gpl)( as published by the free software foundation)?( version| v)? ?1( 0)?", "gpl 1 0( only| or later)?", "gnu org licenses old licenses gpl 1 0"),
    ("gpl-2", "general public licen|gpl", "(gnu )?(general public license|gpl)( as published by the free software foundation)?( either)?( version| v)? ?2( 0)?", "gpl 2 0( only| or later)?", "gnu org licenses (old licenses )?gpl 2 0"),
    ("gpl-3", "general public licen|gpl", "(gnu )?(general public license|gpl)( as published by the free software foundation)?( either)?( version| v)? ?3( 0)?", "gpl 3 0( only| or later)?", "gnu org licenses gpl 3 0"),
    ("gpl", "general public licen|gpl", "(gnu general public license|gnu gpl)", "gpl", "gnu org licenses gpl"),
    ("lgpl-2", "library general|lgpl", "(gnu )?(library general public license|lgpl)( version| v)? ?2( 0)?(?! 1)", "lgpl 2 0( only| or later)?", "gnu org licenses old licenses lgpl 2 0"),
    ("lgpl-2.1", "lesser general|lgpl", "(gnu )?(lesser general public license|lgpl)( version| v)? ?2 1", "lgpl 2 1( only| or later)?", "gnu org licenses (old licenses )?lgpl 2 1"),
    ("lgpl-3", "lesser general|lgpl", "(gnu )?(lesser general public license|lgpl)( version| v)? ?3( 0)?", "lgpl 3 0( only| or later)?", "gnu org licenses lgpl 3 0"),
    ("agpl-3", "affero|agpl", "(gnu )?(affero general public license|agpl)( version| v)? ?3( 0)?", "agpl 3 0( only| or later)?", "gnu org licenses agpl 3 0"),
    ("fdl-1.3", "free documentation|fdl|gfdl", "(gnu )?(free documentation license|fdl|gfdl)( version| v)? ?1 [123]", "gfdl 1 [123]( only| or later)?", "gnu org licenses fdl 1 3"),
    ("mpl-1.1", "mozilla|mpl", "(mozilla public license|mpl)( version| v)? ?1 1", "mpl 1 1", "mozilla org mpl 1 1"),
    ("mpl-2", "mozilla|mpl", "(mozilla public license|mpl)( version| v)? ?2( 0)?", "mpl 2 0", "mozilla org (en us )?mpl 2 0"),
    ("epl-1", "eclipse|epl", "(eclipse public license|epl)( version| v)? ?1( 0)?", "epl 1 0", "eclipse org legal epl v10"),
    ("epl-2", "eclipse|epl", "(eclipse public license|epl)( version| v)? ?2( 0)?", "epl 2 0", "eclipse org legal epl 2 0"),
    ("eupl-1.2", "european union|eupl", "(european union public licen[cs]e|eupl)( version| v)? ?1 [012]", "eupl 1 [012]", "joinup ec europa eu (collection )?eupl"),
    ("cddl-1", "common development|cddl", "(common development and distribution license|cddl)( version| v)? ?1 [01]", "cddl 1 [01]", "opensource org licenses cddl 1 0"),
    ("cpl-1", "common public|cpl", "(common public license|cpl)( version| v)? ?1( 0)?", "cpl 1 0", "opensource org licenses cpl1 0"),
    ("artistic-2", "artistic", "(perl )?artistic license( version| v)? ?2( 0)?", "artistic 2 0", "opensource org licenses artistic 2 0"),
    ("artistic-1", "artistic", "(perl )?artistic license( version| v)? ?1( 0)?", "artistic 1 0", "opensource org licenses artistic 1 0"),
    ("bsl-1", "boost", "boost( software)? license( version| v)? ?1( 0)?", "bsl 1 0", "boost org license 1 0"),
    ("unlicense", "unlicense", "(the )?unlicense", "unlicense", "unlicense org"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl", "wtfpl net"),
    ("zlib", "zlib", "zlib( libpng)?", "zlib", "opensource org licenses zlib"),
    ("postgresql", "postgresql", "postgresql", "postgresql", "opensource org licenses postgresql"),
    ("python-2", "python|psf", "(python software foundation license|psf license|python license)( version| v)? ?2?", "(python|psf) 2 0", "docs python org 3 license"),
    ("php-3", "php", "php license( version| v)? ?3( 0[01]?)?", "php 3 0[01]?", "php net license"),
    ("openssl", "openssl", "openssl", "openssl", "openssl org source license"),
    ("ofl-1.1", "open font|ofl", "(sil )?(open font license|ofl)( version| v)? ?1 1", "ofl 1 1", "scripts sil org ofl"),
    ("odbl-1", "open database|odbl", "(open database license|odbl)( version| v)? ?1?( 0)?", "odbl 1 0", "opendatacommons org licenses odbl"),
    ("ms-pl", "microsoft public|ms pl", "(microsoft public license|ms pl)", "ms pl", "opensource org licenses ms pl"),
    ("cc0", "cc0|cc zero|commons zero", "(cc0|cc zero|creative commons zero)( 1 0)?( universal)?", "cc0 1 0", "creativecommons org publicdomain zero 1 0"),
    ("cc-by", "cc by|commons attribution", "(cc by|creative commons attribution)(?! nc| sa| nd| non| share| no deriv)( [1-4] 0)?( international| unported)?", "cc by [1-4] 0", "creativecommons org licenses by [1-4] 0"),
    ("cc-by-sa", "cc by|commons attribution", "(cc by sa|creative commons attribution share ?alike)( [1-4] 0)?( international| unported)?", "cc by sa [1-4] 0", "creativecommons org licenses by sa [1-4] 0"),
    ("cc-by-nd", "cc by|commons attribution", "(cc by nd|creative commons attribution no ?deriv(ative|ative work)?s?)( [1-4] 0)?( international| unported)?", "cc by nd [1-4] 0", "creativecommons org licenses by nd [1-4] 0"),
    ("cc-by-nc", "cc by|commons attribution", "(cc by nc|creative commons attribution non ?commercial)(?! sa| nd| share| no ?deriv)( [1-4] 0)?( international| unported)?", "cc by nc [1-4] 0", "creativecommons org licenses by nc [1-4] 0"),
    ("cc-by-nc-sa", "cc by|commons attribution", "(cc by nc sa|creative commons attribution non ?commercial share ?alike)( [1-4] 0)?( international| unported)?", "cc by nc sa [1-4] 0", "creativecommons org licenses by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "cc by|commons attribution", "(cc by nc nd|creative commons attribution non ?commercial no ?deriv(ative)?s?)( [1-4] 0)?( international| unported)?", "cc by nc nd [1-4] 0", "creativecommons org licenses by nc nd [1-4] 0"),
    ("public-domain", "public domain", "(the )?public domain", "public domain", "creativecommons org publicdomain mark"),
    ("proprietary", "rights reserved", "all rights reserved", "licenseref proprietary", "license proprietary"),
)

# Label, a keyword that every match has, and the pattern of a sentence of the license or of its notice. What
# another pattern's match contains gives way to it, so that a longer sentence tells licenses of one beginning apart.
NOTICES = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation"),
    ("ncsa", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software"),
    ("x11", "x consortium", "the name of the x consortium shall not be used in advertising"),
    ("bsl-1", "hereby granted", "permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation"),
    ("ofl-1.1", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of the font software"),
    ("ofl-1.1", "font software", "this font software is licensed under the sil open font license"),
    ("isc", "hereby granted", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted provided that"),
    ("0bsd", "hereby granted", "permission to use copy modify and( or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("postgresql", "hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("hpnd", "hereby granted", "permission to use copy modify( and)? distribute( and sell)? this software and its documentation for any purpose (and without fee is hereby granted|is hereby granted without fee)"),
    ("bsd-2-clause", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted provided that( [^ ]+){1,160}? (neither the names? of|the names? of the (author|copyright holder|contributors)[^ ]* may not be used)"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-1-clause", "redistribution and use", "redistribution and use in source code form with or without modification (is|are) permitted"),
    ("zlib", "held liable", "in no event will the authors? be held liable for any damages arising from the use of this software permission is granted to anyone"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("libpng-2", "png reference library", "the png reference library is supplied as is"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "do what the", "do what the fuck you want to( public license)?"),
    ("beerware", "retain this notice", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("json", "good not evil", "the software shall be used for good not evil"),
    ("vim", "charityware", "vim is charityware"),
    ("apache-2", "may not use this file", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2", "reproduction and distribution", "apache license version 2 0 january 2004( [^ ]+){0,6} terms and conditions for use reproduction and distribution"),
    ("apache-1.1", "apache software foundation", "this product includes software developed by the apache software foundation"),
    ("gpl-2", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation( either)? version 2"),
    ("gpl-3", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation( either)? version 3"),
    ("gpl", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl-2", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("lgpl-2.1", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation( either)? version 2 1"),
    ("lgpl-3", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation( either)? version 3"),
    ("agpl-3", "free software", "is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl-1", "february 1989", "gnu general public license version 1 february 1989"),
    ("gpl-2", "june 1991", "gnu general public license version 2 june 1991"),
    ("gpl-3", "29 june 2007", "gnu general public license version 3 29 june 2007"),
    ("lgpl-2", "june 1991", "gnu library general public license version 2 june 1991"),
    ("lgpl-2.1", "february 1999", "gnu lesser general public license version 2 1 february 1999"),
    ("lgpl-3", "29 june 2007", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3", "19 november 2007", "gnu affero general public license version 3 19 november 2007"),
    ("fdl-1.3", "distribute and or modify this document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("mpl-2", "source code form", "this source code form is subject to the terms of the mozilla public license v( ersion)? ?2 0"),
    ("mpl-1.1", "contents of this file", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1", "contents of this file", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("cddl-1", "contents of this file", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl-1", "accompanying materials", "the accompanying materials are made available under the terms of the eclipse public license v(ersion)? ?1 0"),
    ("epl-2", "accompanying materials", "the accompanying materials are made available under the terms of the eclipse public license v?(ersion)? ?2 0"),
    ("cpl-1", "accompanying materials", "the accompanying materials are made available under the terms of the common public license v(ersion)? ?1 0"),
    ("ipl-1", "ibm public license", "ibm public license version 1 0"),
    ("eupl-1.2", "eupl", "licensed under the eupl( version| v)? ?1 [012]( or as soon they will be approved)?"),
    ("cecill-2", "cecill", "cecill (free software )?licen[cs]e( agreement)?( version)?( 2 [01])?"),
    ("afl-3", "academic free license", "academic free license( version| v)?( 3 0)?"),
    ("osl-3", "open software license", "open software license( version| v)?( 3 0)?"),
    ("qpl-1", "q public license", "the q public license( version 1 0)?"),
    ("artistic-1", "same terms as perl", "(under|on) the same terms as perl( 5)? itself"),
    ("ruby", "same terms as ruby", "(under|on) the same terms as ruby itself"),
    ("python-2", "psf is making python", "psf is making python( [0-9. ]+)? available to licensee on an as is basis"),
    ("php-3", "php software", "this product includes php software freely available from"),
    ("openssl", "openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ms-pl", "accompanying software", "microsoft public license ms pl this license governs use of the accompanying software"),
    ("ms-rl", "microsoft reciprocal", "microsoft reciprocal license( ms rl)?"),
    ("cc0", "this deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0", "neighboring rights", "waived all copyright and related or neighboring rights"),
    ("odc-by-1", "open data commons attribution", "open data commons attribution license( v1 0)?"),
    ("pddl-1", "open data commons public domain", "open data commons public domain dedication( and)? licen[cs]e"),
    ("sspl-1", "server side public license", "server side public license( version| v)?( 1)?"),
    ("busl-1.1", "business source license", "business source license( version| v)?( 1 1)?"),
    ("elastic-2", "elastic license", "elastic license( version| v)?( 2 0)?"),
    ("commons-clause", "commons clause", "commons clause( license condition)?( v1 0)?"),
    ("polyform-nc-1", "polyform", "polyform noncommercial license( 1 0 0)?"),
    ("openrail-m", "openrail|open rail", "(creativeml |bigscience |bigcode )?open ?rail (m|d|s|ms)( licen[cs]e)?"),
    ("llama", "llama", "llama [0-9]( [0-9])? community license( agreement)?"),
    ("us-government-work", "states government|u s government", "(is|as) a work of the (united states|u s) government( and)? is not subject to copyright"),
    ("proprietary", "strictly prohibited", "unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("proprietary", "proprietary and confidential|confidential and proprietary", "(proprietary and confidential|confidential and proprietary)"),
)
NOTICE_PRIORITY = 4

# The form's name, its priority, a keyword of the form (an address has its first two words), the pattern around {n} (or {s} for the tag, {u} for the address).
FORMS = (
    ("tag", 5, "spdx", "spdx license identifier {s}"),
    ("address", 4, "", "{u}"),
    ("grant", 3, "licen", "licen[cs]ed( to you)? under( the)?( terms( and conditions)? of( the)?| conditions of( the)?)? {n}( licen[cs]e)?"),
    ("release", 3, " under | by ", "(released|distributed|available|published|shared|covered|governed|provided)( freely)? (under|by)( the)?( terms of( the)?)? {n}( licen[cs]e)?"),
    ("field", 3, "licen", "licen[cs]es? {n}( licen[cs]e)?"),
    ("title", 2, "licen", "(the )?{n} licen[cs]e"),
    ("name", 1, "", "{n}"),
)
#: Names that are ordinary words too: these need a form around them.
COMMON = ("mit", "mit-0", "isc", "zlib", "openssl", "postgresql", "public-domain", "wtfpl")
#: What a place of each priority says for the score.
CONFIDENCE = {1: 0.6, 2: 0.8, 3: 0.9, 4: 0.95, 5: 1.0}
BASE_CONFIDENCE = 0.8


class Rule(NamedTuple):
    label: str
    priority: int
    keywords: tuple[str, str]
    pattern: str


def rules() -> list[Rule]:
    """The rules in order: by priority, notices first, then as the names are listed."""
    found = [Rule(label, NOTICE_PRIORITY, ("", key), pattern) for label, key, pattern in NOTICES]
    for form, priority, key, around in sorted(FORMS, key=lambda f: -f[1]):
        for label, own, name, tag, address in NAMES:
            if form == "name" and label in COMMON:
                continue
            named = " ".join(address.split(" ")[:2]) if form == "address" else "" if form == "tag" else own
            found.append(Rule(label, priority, (key, named), around.format(n=f"(?:{name})", s=f"(?:{tag})", u=f"(?:{address})")))
    return sorted(found, key=lambda r: -r.priority)


def gate(all_rules: list[Rule]) -> str:
    """A pattern that a text without any rule's keywords lacks: for each rule the keywords of its name, or of its form if it names none.

    Keywords stand at the beginning of a word, so that each word is looked at once, by its first sign. One that begins
    with another adds nothing.
    """
    keys = sorted({key.strip() for rule in all_rules for key in (rule.keywords[1] or rule.keywords[0]).split("|")})
    keys = [key for key in keys if not any(key != other and key.startswith(other) for other in keys)]
    by_sign: dict[str, list[str]] = {}
    for key in keys:
        by_sign.setdefault(key[0], []).append(key[1:])
    return " (?:" + "|".join(f"{sign}(?:{'|'.join(rest)})" for sign, rest in by_sign.items()) + ")"


def normalised(text: Column) -> Column:
    """The words of a text, A-Z lower-cased, separated by single spaces."""
    return F.trim(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), NOT_WORD, " "))


def _n_words(words: Column) -> Column:
    return F.when(words == "", 0).otherwise(F.length(words) - F.length(F.replace(words, F.lit(" "), F.lit(""))) + 1).cast("bigint")


def _base(words: Column, n_words: Column) -> Column:
    """For each base phrase the struct (n, first, last) of its places, in words; null without any."""

    def of(phrase: str) -> Column:
        wide = f" {phrase.replace(' ', '  ')} "
        pieces = F.split(F.concat(F.lit(" "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" ")), wide)
        size = phrase.count(" ") + 1
        within = lambda piece: ((F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))) / 2).cast("bigint")
        places = let(pieces, lambda p: F.struct((F.size(p) - 1).cast("bigint").alias("n"), within(p[0]).alias("first"), (n_words - within(F.get(p, F.size(p) - 1)) - size).alias("last")))
        return F.when(F.concat(F.lit(" "), words, F.lit(" ")).contains(f" {phrase} "), places)

    return F.array(*(of(phrase) for phrase, _ in BASE))


def _listed(values: list[str], sep: str = "\n") -> Column:
    """A fixed array, as one literal that the optimiser folds."""
    return F.split(F.lit(sep.join(values)), sep)


def detections(words: Column, all_rules: list[Rule] | None = None) -> Column:
    """Detections that stay, as (start, neg_end, neg_priority, rule): places in characters of the words enclosed by spaces."""
    own = rules() if all_rules is None else all_rules
    needs = [_listed([r.keywords[k] for r in own]) for k in (0, 1)]
    keys = _listed(sorted({key for r in own for need in r.keywords for key in need.split("|")}))
    patterns = _listed([rf"(?<= )(?:{r.pattern})(?= )" for r in own])
    priorities = _listed([str(r.priority) for r in own]).cast("array<int>")
    padded = F.concat(F.lit(" "), words, F.lit(" "))
    kind = "array<struct<start:int,neg_end:int,neg_priority:int,rule:int>>"
    none = F.array().cast(kind)

    def by_rule(text: Column, rule: Column) -> Column:
        pieces = F.split(F.regexp_replace(text, F.get(patterns, rule), F.lit(OPEN + "$0" + CLOSE)), OPEN)

        def step(at: Column, piece: Column) -> tuple[Column, Column]:
            place = F.struct(at.alias("start"), (-at - F.length(F.substring_index(piece, CLOSE, 1))).alias("neg_end"), (-F.get(priorities, rule)).alias("neg_priority"), rule.alias("rule"))
            return at + F.length(piece) - 1, F.array(place)

        return let(pieces, lambda p: folded(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), F.length(p[0]), kind, step))

    def met(need: Column, i: Column, present: Column) -> Column:
        return F.exists(F.split(F.get(need, i), "\\|"), lambda key: F.array_contains(present, key))

    def search(text: Column) -> Column:
        # Each keyword is looked for once; a rule's pattern runs only if it has one of both its needs.
        able = let(F.filter(keys, lambda key: F.contains(text, key)), lambda present: F.filter(F.sequence(F.lit(0), F.lit(len(own) - 1)), lambda i: met(needs[0], i, present) & met(needs[1], i, present)))
        return F.array_sort(F.flatten(F.transform(able, lambda i: by_rule(text, i))))

    # In order of start, then longest, then highest priority: a place is inside an earlier one if that one's end is no smaller.
    def sweep(ends: Column, d: Column) -> tuple[Column, Column]:
        level = -d["neg_priority"]
        hidden = F.exists(F.slice(ends, level, 6 - level), lambda e: e >= -d["neg_end"])
        later = F.transform(ends, lambda e, i: F.when(i + 1 == level, F.greatest(e, -d["neg_end"])).otherwise(e))
        return F.when(hidden, ends).otherwise(later), F.when(hidden, none).otherwise(F.array(d))

    return F.when(F.rlike(padded, F.lit(gate(own))), let(padded, lambda t: let(search(t), lambda found: folded(found, F.array(*[F.lit(-1)] * 5), kind, sweep)))).otherwise(none)


def scan(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    Null and wordless texts have no words, no labels and score 0. The score is the confidence of the best detection
    that stays, base phrases included. Repeated rows each get a row; other columns are ignored, whatever their names;
    an empty table gives no rows.
    """
    own = rules()
    words = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normalised(F.col("text")).alias("words"))
    counted = words.withColumn("n_words", _n_words(F.col("words")))
    found = counted.select("doc_id", "n_words", _base(F.col("words"), F.col("n_words")).alias("base"), detections(F.col("words"), own).alias("found"))
    base, places = F.col("base"), F.col("found")
    have = lambda f: F.filter(F.transform(base, f), lambda x: x.isNotNull())
    base_labels = F.filter(F.array(*(F.when(base[k].isNotNull(), F.lit(label)) for k, (_, label) in enumerate(BASE))), lambda x: x.isNotNull())
    labels = F.transform(places, lambda d: F.get(_listed([r.label for r in own]), d["rule"]))
    confidence = F.array(*(F.lit(CONFIDENCE[k]) for k in sorted(CONFIDENCE)))
    best = F.greatest(F.coalesce(F.array_max(F.transform(places, lambda d: F.get(confidence, -d["neg_priority"] - 1))), F.lit(0.0)), F.when(F.size(base_labels) > 0, BASE_CONFIDENCE).otherwise(0.0))
    return found.select(
        "doc_id", "n_words", F.aggregate(have(lambda b: b["n"]), F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_base"),
        F.array_min(have(lambda b: b["first"])).alias("first_word"), F.array_max(have(lambda b: b["last"])).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"), F.array_join(F.array_sort(F.array_distinct(F.concat(base_labels, labels))), ",").alias("labels"), best.alias("score"),
    )
