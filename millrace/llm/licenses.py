"""License scan: ordered signature rules over words, in built-in functions only and in one pass without a shuffle.

Texts become lower-case words joined by single blanks. A rule has a keyword, a regular expression over such text, a label and a
priority. Rules run only where their keyword occurs. Of overlapping detections one that lies within another (or equals
one of better priority) is dropped; what is left gives the labels and the share of words covered.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_documents, bound


@dataclass(frozen=True)
class Rule:
    keyword: str
    pattern: str
    label: str
    priority: int


#: The phrases every scan counts, with their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


#: Signatures of grants, headers and notices by their wording: keyword, pattern, label. Words of license texts are fixed values.
NOTICES = (
    ("this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("this library is free software", "this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license", "lgpl-notice"),
    ("is free software", "[a-z0-9]+ is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl-notice"),
    ("is free software", "is free software you can redistribute it and or modify it under the terms of the gnu affero general public license", "agpl-notice"),
    ("hope that it will be useful", "distributed in the hope that it will be useful but without any warranty", "gnu-no-warranty"),
    ("merchantability or fitness", "without even the implied warranty of merchantability or fitness for a particular purpose", "gnu-no-warranty"),
    ("should have received a copy", "you should have received a copy of the gnu (lesser |affero |library )?general public license along with", "gnu-copy-notice"),
    ("gnu general public license as published", "gnu general public license as published by the free software foundation", "gpl"),
    ("gnu lesser general public license as published", "gnu lesser general public license as published by the free software foundation", "lgpl"),
    ("gnu affero general public license as published", "gnu affero general public license as published by the free software foundation", "agpl"),
    ("gnu library general public license", "gnu library general public license( version 2)?", "lgpl-2.0"),
    ("invariant sections", "with no invariant sections (no|with no) front cover texts and (no|with no) back cover texts", "fdl-no-invariants"),
    ("gcc runtime library exception", "gcc runtime library exception( version 3 1)?", "gcc-exception"),
    ("classpath exception", "classpath exception( 2 0)?", "classpath-exception"),
    ("linking this library statically", "linking this library statically or dynamically with other modules is making a combined work", "classpath-exception"),
    ("bison exception", "bison exception( 2 2)?", "bison-exception"),
    ("except in compliance with the license", "you may not use this file except in compliance with the license", "apache-notice"),
    ("licensed to the apache software foundation", "licensed to the apache software foundation asf under one or more contributor license agreements", "apache-notice"),
    ("on an as is basis", "distributed on an as is basis without warranties or conditions of any kind", "apache-no-warranty"),
    ("includes software developed by the apache", "this product includes software developed (by|at) the apache software foundation", "apache-notice"),
    ("apache org licenses license", "www apache org licenses license 2 0", "apache-2.0"),
    ("subject to the terms of the mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("if a copy of the mpl", "if a copy of the mpl was not distributed with this file you can obtain one at", "mpl-2.0"),
    ("incompatible with secondary licenses", "this source code form is incompatible with secondary licenses", "mpl-2.0-no-copyleft-exception"),
    ("subject to the mozilla public license", "the contents of this file are subject to the mozilla public license version 1 [01]", "mpl-notice"),
    ("subject to the netscape public license", "the contents of this file are subject to the netscape public license( version 1 [01])?", "npl-notice"),
    ("subject to the terms of the common development", "the contents of this file are subject to the terms of the common development and distribution license", "cddl-notice"),
    ("made available under the terms of the eclipse", "(this program and the )?accompanying materials are made available under the terms of the eclipse public license", "epl-notice"),
    ("licensed under the eupl", "licensed under the eupl( version 1 [012])?", "eupl-notice"),
    ("permission is hereby granted", "permission is hereby granted without written agreement and without license or royalty fees to use copy modify and distribute this software", "mit-modern"),
    ("permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation", "bsl-1.0"),
    ("above copyright notice and this permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "mit-condition"),
    ("permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice", "isc"),
    ("permission to use copy modify", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", "0bsd"),
    ("permission to use copy modify", "permission to use copy modify (and )?distribute and sell this software and its documentation for any purpose", "hpnd-sell"),
    ("permission to use copy modify", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee", "hpnd"),
    ("redistributions of source code must retain", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "bsd-condition"),
    ("redistributions in binary form must reproduce", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer", "bsd-condition"),
    ("all advertising materials mentioning", "all advertising materials mentioning features or use of this software must display the following acknowledg?e?ment", "bsd-4-clause"),
    ("may be used to endorse", "may be used to endorse or promote products derived from this software without specific prior written permission", "bsd-3-clause"),
    ("no express or implied licenses to any party", "no express or implied licenses to any party s patent rights are granted by this license", "bsd-3-clause-clear"),
    ("provided by the copyright holders and contributors", "this software is provided by the copyright holders and contributors as is", "bsd-disclaimer"),
    ("provided by the regents and contributors", "this software is provided by the regents and contributors as is", "bsd-disclaimer"),
    ("altered source versions must be plainly marked", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software", "zlib"),
    ("origin of this software must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software", "zlib"),
    ("in no event will the authors be held liable", "in no event will the authors be held liable for any damages arising from the use of this software", "zlib"),
    ("anyone is free to copy modify publish", "anyone is free to copy modify publish use compile sell or distribute this software", "unlicense"),
    ("distributed under the boost software license", "distributed under the boost software license( version 1 0)?", "bsl-1.0"),
    ("waived all copyright", "(has|have) waived all copyright and related or neighbou?ring rights", "cc0-1.0"),
    ("no rights reserved", "no rights reserved", "public-domain"),
    ("placed in the public domain", "(is|are|been) (hereby )?placed in the public domain", "public-domain"),
    ("released into the public domain", "(is|are|been) (hereby )?released into the public domain", "public-domain"),
    ("released to the public domain", "(is|are|been) (hereby )?released to the public domain", "public-domain"),
    ("author disclaims copyright", "the author disclaims copyright to this source code", "blessing"),
    ("creativecommons org licenses", "creativecommons org licenses by 4 0", "cc-by-4.0"),
    ("creativecommons org licenses", "creativecommons org licenses by 3 0", "cc-by-3.0"),
    ("creativecommons org licenses", "creativecommons org licenses by sa 4 0", "cc-by-sa-4.0"),
    ("creativecommons org licenses", "creativecommons org licenses by sa 3 0", "cc-by-sa-3.0"),
    ("creativecommons org licenses", "creativecommons org licenses by nc 4 0", "cc-by-nc-4.0"),
    ("creativecommons org licenses", "creativecommons org licenses by nc sa 4 0", "cc-by-nc-sa-4.0"),
    ("creativecommons org licenses", "creativecommons org licenses by nd 4 0", "cc-by-nd-4.0"),
    ("creativecommons org licenses", "creativecommons org licenses by nc nd 4 0", "cc-by-nc-nd-4.0"),
    ("creativecommons org publicdomain", "creativecommons org publicdomain zero 1 0", "cc0-1.0"),
    ("creativecommons org publicdomain", "creativecommons org publicdomain mark 1 0", "public-domain"),
    ("opensource org licenses", "opensource org licenses mit( license php)?", "mit"),
    ("opensource org licenses", "opensource org licenses bsd (3|2) clause", "bsd"),
    ("opensource org licenses", "opensource org licenses isc", "isc"),
    ("gnu org licenses", "gnu org licenses gpl( 3 0| 2 0)?( html| txt)?", "gpl"),
    ("gnu org licenses", "gnu org licenses lgpl( 3 0| 2 1)?( html| txt)?", "lgpl"),
    ("gnu org licenses", "gnu org licenses agpl( 3 0)?( html| txt)?", "agpl"),
    ("gnu org licenses", "gnu org licenses fdl( 1 3)?( html| txt)?", "fdl"),
    ("mozilla org mpl", "mozilla org mpl 2 0", "mpl-2.0"),
    ("mozilla org mpl", "mozilla org mpl mpl 1 1", "mpl-1.1"),
    ("eclipse org legal", "eclipse org legal epl (v10|v20|2 0)( html)?", "epl"),
    ("scripts sil org ofl", "scripts sil org ofl", "ofl"),
    ("open data commons", "open data commons open database license( odbl)?( v? ?1 0)?", "odbl-1.0"),
    ("open data commons", "open data commons attribution license( odc by)?( v? ?1 0)?", "odc-by-1.0"),
    ("open data commons", "open data commons public domain dedication and licen[cs]e( pddl)?( v? ?1 0)?", "pddl-1.0"),
    ("open government licence", "open government licence( v ?[123]| version [123])?( 0)?", "ogl"),
    ("opendatacommons org licenses", "opendatacommons org licenses (odbl|by|pddl)( 1 0)?", "odc"),
    ("server side public license", "server side public license( version 1| v1)?", "sspl-1.0"),
    ("business source license", "business source license( 1 1)?", "busl-1.1"),
    ("elastic license", "elastic license( 2 0| v2)?", "elastic"),
    ("commons clause", "commons clause( license condition)?( v ?1 0)?", "commons-clause"),
    ("prosperity public license", "prosperity public license( 3 0 0| 2 0 0)?", "prosperity"),
    ("polyform", "polyform (noncommercial|small business|shield|strict|free trial|internal use) license( 1 0 0)?", "polyform"),
    ("hippocratic license", "hippocratic license( version)?( [123]( [0-9])?)?", "hippocratic"),
    ("community data license agreement", "community data license agreement permissive( version 2 0| version 1 0)?", "cdla-permissive"),
    ("community data license agreement", "community data license agreement sharing( version 1 0)?", "cdla-sharing"),
    ("responsible ai license", "(bigscience |creativeml )?(open )?(rail m |rail )?responsible ai license", "openrail"),
    ("creativeml open rail", "creativeml open rail ?m( license)?", "openrail"),
    ("llama 2 community license", "llama 2 community license( agreement)?", "llama-2"),
    ("llama 3 community license", "(meta )?llama 3 community license( agreement)?", "llama-3"),
    ("mulan permissive software license", "mulan permissive software license( v ?[12]| version [12])?", "mulanpsl"),
    ("cecill", "cecill (b |c )?(free software )?license( agreement)?( version 2( [01])?| v2( [01])?)?", "cecill"),
    ("blue oak model license", "blue oak model license( 1 0 0)?", "blueoak-1.0.0"),
    ("universal permissive license", "universal permissive license( v 1 0| version 1 0)?", "upl-1.0"),
    ("ncsa open source license", "(university of illinois )?ncsa open source license", "ncsa"),
    ("postgresql license", "(the )?postgresql license", "postgresql"),
    ("php license", "(the )?php license( version 3 01| version 3 0)?", "php"),
    ("ruby license", "(the )?ruby license", "ruby"),
    ("vim license", "(the )?vim license", "vim"),
    ("openssl license", "(the )?openssl license", "openssl"),
    ("developed by the openssl project", "this product includes software developed by the openssl project for use in the openssl toolkit", "openssl"),
    ("curl license", "(the )?curl license", "curl"),
    ("ibm public license", "ibm public license( version)?( 1 0)?", "ipl-1.0"),
    ("sun public license", "sun public license( version)?( 1 0)?", "spl-1.0"),
    ("sun industry standards source license", "sun industry standards source license( version)?( 1 [12])?", "sissl"),
    ("apple public source license", "apple public source license( version)?( 2 0| 1 [012])?", "apsl"),
    ("q public license", "q public license( version)?( 1 0)?", "qpl-1.0"),
    ("sleepycat license", "(the )?sleepycat license", "sleepycat"),
    ("w3c software", "w3c software (notice and|and document) (document )?(notice and )?license", "w3c"),
    ("unicode license", "unicode license( v3| agreement)?", "unicode"),
    ("info zip license", "info zip license", "info-zip"),
    ("freetype project license", "(the )?freetype project license", "ftl"),
    ("independent jpeg group", "based in part on the work of the independent jpeg group", "ijg"),
    ("beerware license", "the beerware license( revision 42)?", "beerware"),
    ("as long as you retain this notice you", "as long as you retain this notice you can do whatever you want with this stuff", "beerware"),
    ("do what the fuck", "you just do what the fuck you want to", "wtfpl"),
    ("json org license", "(the )?json (org )?license", "json"),
    ("used for good not evil", "the software shall be used for good not evil", "json"),
    ("proprietary and confidential", "(is |are )?proprietary and confidential", "proprietary"),
    ("unauthorized copying of this file", "unauthorized copying of this file via any medium is strictly prohibited", "proprietary"),
    ("may not be reproduced", "(may|must) not be reproduced (in whole or in part |or distributed )?without (the )?(prior )?(express )?(written )?(permission|consent)", "no-reproduction"),
    ("reproduction without permission", "reproduction without permission is prohibited", "no-reproduction"),
    ("for personal use only", "for personal use only", "personal-use"),
    ("for non commercial use only", "for non commercial use only", "non-commercial"),
    ("free for non commercial use", "free for non commercial use", "non-commercial"),
    ("end user license agreement", "end user license agreement", "eula"),
    ("used with permission", "used with permission", "used-with-permission"),
    ("dual licensed under", "dual licensed under (the )?(terms of )?(the )?(mit|apache|gpl|bsd|lgpl|mpl)", "dual"),
    ("either the mit license or", "either the mit license or (the )?(gpl|apache license|gnu general public license)", "dual"),
    ("licensed under either of", "licensed under either of (the )?apache license version 2 0 or (the )?mit license", "dual"),
    ("same terms as perl itself", "under the same terms as perl itself", "perl"),
    ("open font license", "licensed under the sil open font license version 1 1", "ofl-1.1"),
    ("bitstream vera", "bitstream vera (fonts? )?copyright", "bitstream-vera"),
)


def _number(version: str) -> str:
    """Words of a version: 2 and 2.0 are one, and 2 before another minor version (as in 2.1) is no version 2.0."""
    major, minor = version.split(".")
    return f"{major}( 0|(?! [1-9][a-c]? ))" if minor == "0" else f"{major} {minor}"


def rules() -> list[Rule]:
    """The signature rules, more exact ones first; families of licenses, by the versions that exist, make hundreds of them.

    A pattern sees words joined by single blanks; a dotted version such as 2.0 is two words there.
    """
    out: list[tuple[str, str, str]] = []
    add = lambda keyword, pattern, label: out.append((keyword, pattern, label))
    # Grants and headers whose wording names the license.
    add("permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy( of this software)?", "mit")
    add("permission to use copy modify", "permission to use copy modify and (or )?distribute this software for any purpose", "isc")
    for keyword, pattern, label in NOTICES:
        add(keyword, pattern, label)
    add("redistribution and use", "redistribution and use in source and binary forms with or without modification( are permitted)?", "bsd")
    add("neither the name", "neither the names? of .{1,80}? nor the names of (its|their) contributors may be used", "bsd-3-clause")
    add("free and unencumbered", "this is free and unencumbered software released into the public domain", "unlicense")
    add("boost software license", "boost software license( version)? 1 0", "bsl-1.0")
    add("provided as is", "(this )?(software|work) is provided as is without (express or implied )?warranty", "warranty-disclaimer")
    add("all rights reserved", "all rights reserved", "all-rights-reserved")
    add("dedicated to the public domain", "dedicated to the public domain", "public-domain")
    add("do what the fuck", "do what the fuck you want to public license", "wtfpl")
    # Copyleft families: names and short names, by version that exists, with and without later versions.
    gnu = {
        "gpl": (("general public license", "gpl"), "1.0 2.0 3.0"), "lgpl": (("lesser general public license", "lgpl"), "2.0 2.1 3.0"),
        "agpl": (("affero general public license", "agpl"), "1.0 2.0 3.0"), "fdl": (("free documentation license", "fdl"), "1.1 1.2 1.3"),
    }
    for label, (names, versions) in gnu.items():
        for version, name in product(versions.split(), names):
            number = f"(gnu )?{name}( license)?( as published by the free software foundation)?( either)? ?(version |v ?)?{_number(version)}"
            add(name, f"{number} (or (at your option )?any later version|or later|only or later)", f"{label}-{version}-or-later")
            add(name, f"{number} only", f"{label}-{version}-only")
            add(name, number, f"{label}-{version}")
        for version in versions.split():
            add(f"spdx license identifier {label}", f"spdx license identifier {label} {_number(version)}( (only|or later))?", f"{label}-{version}")
        add(f"gnu {label}", f"gnu {label}( license)?", label)
    # Versioned permissive and weak copyleft families.
    families = {
        "apache": (("apache license", "apache software license"), "1.0 1.1 2.0"), "mpl": (("mozilla public license",), "1.0 1.1 2.0"), "epl": (("eclipse public license",), "1.0 2.0"),
        "cddl": (("common development and distribution license",), "1.0 1.1"), "eupl": (("european union public licen[cs]e",), "1.0 1.1 1.2"), "artistic": (("artistic license",), "1.0 2.0"),
        "osl": (("open software license",), "1.0 1.1 2.0 2.1 3.0"), "afl": (("academic free license",), "1.0 1.1 1.2 2.0 2.1 3.0"), "cpl": (("common public license",), "1.0"), "ms-pl": (("microsoft public license",), ""),
        "python": (("python software foundation license",), "2.0"), "zpl": (("zope public license",), "1.0 1.1 2.0 2.1"), "lppl": (("latex project public license",), "1.0 1.1 1.2 1.3 1.3a 1.3b 1.3c"), "ofl": (("sil open font license",), "1.0 1.1"),
    }
    for label, (names, versions) in families.items():
        for version in versions.split():
            for name in names:
                add(name.split("[")[0], f"{name} ?(version |v ?)?{_number(version)}", f"{label}-{version}")
            add(f"spdx license identifier {label.replace('-', ' ')}", f"spdx license identifier {label.replace('-', ' ')} {_number(version)}", f"{label}-{version}")
    for label, (names, _) in families.items():
        for name in names:
            add(name.split("[")[0], name, label)
    # Creative Commons: elements by version.
    elements = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial", "by-nd": "attribution no ?derivatives", "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?derivatives"}
    for (label, words), (version, number) in product(elements.items(), (("1.0", "1 0"), ("2.0", "2 0"), ("2.5", "2 5"), ("3.0", "3 0"), ("4.0", "4 0"))):
        add("creative commons", f"creative commons {words} (international |unported )?{number}( international| unported)?( license)?", f"cc-{label}-{version}")
        add("cc by", f"cc {label.replace('-', ' ')} {number}", f"cc-{label}-{version}")
    for label, words in elements.items():
        add("creative commons", f"creative commons {words}( license)?", f"cc-{label}")
    add("cc0", "cc0( 1 0)?( universal)?", "cc0-1.0")
    add("creative commons", "creative commons( license)?", "cc")
    # BSD by number of clauses, and plain names.
    for number, word in ((0, "zero"), (2, "two"), (3, "three"), (4, "four")):
        add("bsd", f"bsd ({number}|{word}) clause( license)?", f"bsd-{number}-clause")
        add("bsd", f"({number}|{word}) clause bsd( license)?", f"bsd-{number}-clause")
    simple = {"mit": "(the )?mit license", "expat": "expat license", "x11": "x11 license", "isc": "isc license", "zlib": "zlib license", "bsd": "bsd license", "wtfpl": "wtfpl", "unlicense": "the unlicense", "gpl": "(gnu )?general public license", "lgpl": "(gnu )?lesser general public license", "agpl": "(gnu )?affero general public license", "public-domain": "public domain", "proprietary": "proprietary license"}
    keywords = {"gpl": "general public license", "lgpl": "lesser general public license", "agpl": "affero general public license", "mit": "mit license", "public-domain": "public domain", "unlicense": "the unlicense", "proprietary": "proprietary license"}
    for label, pattern in simple.items():
        add(keywords.get(label, label), pattern, label)
        name = label.replace("-", " ")
        add(f"licensed under the {name}", f"licensed under the {name}( license)?", label)
        add(f"spdx license identifier {name}", f"spdx license identifier {name}", label)
    return [Rule(keyword, pattern, label, k) for k, (keyword, pattern, label) in enumerate(out)]


#: Detections and the type of an empty list of them; back is the negative end, so that plain order is by start, longer first, better priority first.
_KIND = "array<struct<start:int,back:int,priority:int,label:string>>"
#: Stands before a match while its place is counted; never part of words.
_MARK = "\x01"


def _words(text: Column) -> Column:
    """Words of a text with one blank before, between and after them; a text without words is a single blank."""
    return F.regexp_replace(F.concat(F.lit(" "), F.coalesce(text, F.lit("")), F.lit(" ")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " ")


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _intervals(joined: Column, pattern: Column, priority: Column, label: Column) -> Column:
    """Detections of all matches of a pattern, in one pass over the words.

    A match begins at the blank before its first word and ends before a blank, so its blanks count its words. The words before which a mark
    stands are the first ones of matches, in the order of matches.
    """

    def detection(start: Column, match: Column) -> Column:
        return F.struct(start.cast("int").alias("start"), (-(start + _blanks(match))).cast("int").alias("back"), priority.alias("priority"), label.alias("label"))

    def body(found: Column) -> Column:
        one = F.array(detection(_blanks(F.get(F.split(joined, pattern, 2), 0)), F.get(found, 0)))
        marked = F.split(F.regexp_replace(joined, pattern, F.lit(f"{_MARK}$0")), " ", -1)
        starts = F.filter(F.transform(marked, lambda w, i: F.when(F.endswith(w, F.lit(_MARK)), i)), lambda i: i.isNotNull())
        return F.when(F.size(found) == 1, one).when(F.size(found) > 1, F.zip_with(starts, found, detection)).otherwise(F.array().cast(_KIND))

    return bound(F.regexp_extract_all(joined, pattern, F.lit(0)), body)


def _uncontained(found: Column) -> Column:
    """Detections without those that lie within another: in plain order, such a one ends no later than the furthest end so far.

    The fold goes through runs of about the square root of all, as what it gathers is copied at every step; a run begins with the furthest end of the runs before.
    """
    step = lambda acc, d: F.struct(F.least(acc["far"], d["back"]).alias("far"), F.when(d["back"] < acc["far"], F.concat(acc["out"], F.array(d))).otherwise(acc["out"]).alias("out"))

    def kept(run: Column, far: Column) -> Column:
        return F.aggregate(run, F.struct(far.alias("far"), F.array().cast(_KIND).alias("out")), step, lambda acc: acc["out"])

    def of_runs(runs: Column) -> Column:
        far = F.transform(runs, lambda r: F.array_min(F.transform(r, lambda d: d["back"])))
        return bound(far, lambda f: F.flatten(F.transform(runs, lambda r, i: kept(r, F.coalesce(F.array_min(F.slice(f, F.lit(1), i)), F.lit(1))))))

    def split(every: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(every))).cast("int")
        return bound(width, lambda w: F.transform(F.sequence(F.lit(0), F.ceil(F.size(every) / w).cast("int") - 1), lambda k: F.slice(every, k * w + 1, w)))

    return F.when(F.size(found) < 2, found).otherwise(bound(bound(F.array_sort(found), split), of_runs))


def _ended(found: Column) -> Column:
    """Detections as start, end, priority and label."""
    return F.transform(found, lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["priority"].alias("priority"), d["label"].alias("label")))


def _covered(found: Column) -> Column:
    """Words within any of the detections."""
    step = lambda acc, d: F.struct(F.greatest(acc["far"], -d["back"]).alias("far"), (acc["n"] + F.greatest(F.lit(0), -d["back"] - F.greatest(acc["far"], d["start"]))).alias("n"))
    return F.aggregate(F.array_sort(found), F.struct(F.lit(0).alias("far"), F.lit(0).alias("n")), step, lambda acc: acc["n"])


def _any_of(words: list[str]) -> str:
    """A regular expression for any of some words of plain characters, with common beginnings written once, so that few alternatives are tried at a place."""
    if "" in words:
        return ""
    first: dict[str, list[str]] = {}
    for w in words:
        first.setdefault(w[0], []).append(w[1:])
    parts = [c + (rest[0] if len(rest) == 1 else _any_of(rest)) for c, rest in sorted(first.items())]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (start, label of the BASE phrases), detections (no one within another), labels (sorted), score.

    Words are numbered from 0; score is the share of words within detections or base phrases. Null and empty texts
    have no words, no labels and score 0; null or repeated ids pass row by row; other columns are ignored.
    """
    every = rules()
    keys = sorted({r.keyword for r in every})
    w = as_documents(docs, "doc_id", "text").select("doc_id", _words(F.col("text")).alias("w"))
    w = w.withColumn("n_words", (_blanks(F.col("w")) - 1).cast("long"))
    low = F.translate("w", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    gate = _any_of(keys)
    w = w.withColumn("low", F.when(F.col("w").rlike(f"(?i) (?:{gate})"), low))

    of_key = [F.array(*(F.struct(F.lit(f" (?:{r.pattern})(?= )").alias("re"), F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label")) for r in every if r.keyword == k)) for k in keys]
    groups = F.array(*(F.struct(F.lit(f" {k}").alias("key"), own.alias("rules")) for k, own in zip(keys, of_key, strict=True)))
    own = F.flatten(F.transform(F.filter(groups, lambda g: F.contains(F.col("low"), g["key"])), lambda g: g["rules"]))
    found = F.flatten(F.transform(own, lambda r: _intervals(F.col("low"), r["re"], r["priority"], r["label"])))
    base = F.flatten(F.array(*(_intervals(F.col("low"), F.lit(f" {p}(?= )"), F.lit(-1), F.lit(label)) for p, label in BASE.items())))
    none = F.array().cast(_KIND)
    w = w.withColumn("base", F.coalesce(F.when(F.contains(F.col("low"), F.lit(" license ")), F.array_sort(base)), none))
    w = w.withColumn("detections", F.coalesce(F.when(F.col("low").isNotNull(), _uncontained(found)), none))
    both = F.concat("base", "detections")
    return w.select(
        "doc_id", "n_words", F.transform("base", lambda d: F.struct(d["start"].alias("start"), d["label"].alias("label"))).alias("base"), _ended(F.col("detections")).alias("detections"),
        F.array_sort(F.array_distinct(F.transform(both, lambda d: d["label"]))).alias("labels"),
        F.when(F.size(both) > 0, _covered(both) / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
    )
