"""Signature rules for licence scans.

Hand-written are FAMILIES (label, keyword, pattern of the name in normalised words,
pattern of the versions), BODIES (wordings of the licences themselves) and JOINED
(names that are written as one word with their version). From each family three
or four rules are derived, in order of priority: a tag that declares it, a grant
that names it, its name with a version, its bare name; a joined name gives a tag,
a grant and a versioned name. Bodies come first. Patterns run on lower-case
words separated by single spaces.
"""

from __future__ import annotations

# Phrases whose places the scan counts, and their labels.
BASE = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

_L = "licen[sc]e"

# label, keyword that must occur as a word, name pattern, version pattern ("" for none)
FAMILIES = [
    ("agpl", "affero", f"(?:gnu )?affero general public {_L}", "3(?: 0)?"),
    ("agpl", "agpl", "(?:gnu )?agpl", "v?3(?: 0)?"),
    ("lgpl", "lesser", f"(?:gnu )?lesser general public {_L}", "(?:2(?: 1)?|3(?: 0)?)"),
    ("lgpl", "library", f"(?:gnu )?library general public {_L}", "2(?: 0)?"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", "v?(?:2(?: 1)?|3(?: 0)?)"),
    ("gpl", "general", f"(?:gnu )?general public {_L}", "(?:1|2|3)(?: 0)?"),
    ("gpl", "gpl", "(?:gnu )?gpl", "v?(?:1|2|3)(?: 0)?"),
    ("gfdl", "documentation", f"(?:gnu )?free documentation {_L}", "1 [123]"),
    ("gfdl", "gfdl", "gfdl", "1 [123]"),
    ("apache", "apache", f"apache(?: software)? {_L}", "(?:1 [01]|2(?: 0)?)"),
    ("mit", "mit", f"mit {_L}", ""),
    ("mit", "expat", f"expat {_L}", ""),
    ("mit", "x11", f"x11 {_L}", ""),
    ("isc", "isc", f"isc {_L}", ""),
    ("bsd-2-clause", "bsd", f"(?:2 clause|two clause|simplified|freebsd) bsd(?: {_L})?|bsd (?:2|two) clause(?: {_L})?", ""),
    ("bsd-3-clause", "bsd", f"(?:3 clause|three clause|new|modified|revised) bsd(?: {_L})?|bsd (?:3|three) clause(?: {_L})?", ""),
    ("bsd-4-clause", "bsd", f"(?:4 clause|four clause|original) bsd(?: {_L})?|bsd (?:4|four) clause(?: {_L})?", ""),
    ("0bsd", "bsd", f"zero clause bsd(?: {_L})?|0 clause bsd", ""),
    ("0bsd", "0bsd", "0bsd", ""),
    ("bsd", "bsd", f"bsd(?: style)? {_L}", ""),
    ("mpl", "mozilla", f"mozilla public {_L}", "(?:1 [01]|2(?: 0)?)"),
    ("mpl", "mpl", "mpl", "(?:1 [01]|2(?: 0)?)"),
    ("epl", "eclipse", f"eclipse public {_L}", "(?:1|2)(?: 0)?"),
    ("epl", "epl", "epl", "(?:1|2)(?: 0)?"),
    ("edl", "eclipse", f"eclipse distribution {_L}", "1(?: 0)?"),
    ("cddl", "cddl", "cddl", "1 [01]"),
    ("cddl", "distribution", f"common development and distribution {_L}", "1 [01]"),
    ("cpl", "common", f"common public {_L}", "1(?: 0)?"),
    ("cpal", "attribution", f"common public attribution {_L}", "1(?: 0)?"),
    ("ipl", "ibm", f"ibm public {_L}", "1(?: 0)?"),
    ("eupl", "eupl", "eupl", "1 [012]"),
    ("eupl", "european", f"european union public {_L}", "1 [012]"),
    ("cecill", "cecill", f"cecill(?: [abc])?(?: {_L})?", "(?:1|2)(?: [01])?"),
    ("artistic", "artistic", f"artistic {_L}", "(?:1|2)(?: 0)?"),
    ("artistic", "clarified", f"clarified artistic {_L}", ""),
    ("boost", "boost", f"boost software {_L}", "1(?: 0)?"),
    ("zlib", "zlib", f"zlib(?: libpng)? {_L}", ""),
    ("libpng", "libpng", f"(?:libpng|png reference library) {_L}", "2(?: 0)?"),
    ("unlicense", "unlicense", f"(?:the )?unlicense(?: {_L})?", ""),
    ("wtfpl", "wtfpl", "wtfpl", "2(?: 0)?"),
    ("ofl", "sil", f"sil open font {_L}", "1 [01]"),
    ("ofl", "font", f"open font {_L}", "1 [01]"),
    ("python", "python", f"python(?: software foundation)? {_L}", "[23](?: \\d+)?"),
    ("psf", "psf", f"psf {_L}", "2(?: 0)?"),
    ("ruby", "ruby", f"ruby {_L}", ""),
    ("php", "php", f"php {_L}", "3(?: 0)?(?: 1)?"),
    ("zope", "zope", f"zope public {_L}", "(?:1 1|2 [01])"),
    ("openssl", "openssl", f"openssl {_L}", ""),
    ("postgresql", "postgresql", f"postgresql {_L}", ""),
    ("ncsa", "illinois", f"university of illinois(?: ncsa)? open source {_L}", ""),
    ("ncsa", "ncsa", f"ncsa(?: open source)? {_L}", ""),
    ("ms-pl", "microsoft", f"microsoft public {_L}", ""),
    ("ms-rl", "reciprocal", f"microsoft reciprocal {_L}", ""),
    ("rpl", "reciprocal", f"reciprocal public {_L}", "1 [15]"),
    ("qpl", "q", f"q public {_L}", "1(?: 0)?"),
    ("qpl", "qt", f"qt public {_L}", "1(?: 0)?"),
    ("osl", "osl", "osl", "[123] [01]"),
    ("osl", "open", f"open software {_L}", "[123] [01]"),
    ("afl", "academic", f"academic free {_L}", "[123] [012]"),
    ("ecl", "educational", f"educational community {_L}", "[12] 0"),
    ("upl", "universal", f"universal permissive {_L}", "1(?: 0)?"),
    ("bsl", "business", f"business source {_L}", "1 [01]"),
    ("sspl", "sspl", "sspl", "v?1(?: 0)?"),
    ("sspl", "server", f"server side public {_L}", "1(?: 0)?"),
    ("elastic", "elastic", f"elastic {_L}", "(?:1|2)(?: 0)?"),
    ("mulan", "mulan", f"mulan permissive(?: software)? {_L}", "[12]"),
    ("blueoak", "oak", f"blue oak model {_L}", "1 0 0"),
    ("hippocratic", "hippocratic", f"hippocratic {_L}", "[123](?: \\d)?"),
    ("rail", "openrail", f"(?:creativeml )?openrail(?: m)?(?: {_L})?", ""),
    ("llama", "llama", f"llama(?: \\d)?(?: \\d)? community {_L}", ""),
    ("odbl", "odbl", "odbl", "1(?: 0)?"),
    ("odbl", "database", f"open database {_L}", "1(?: 0)?"),
    ("odc-by", "commons", f"open data commons attribution {_L}", "1(?: 0)?"),
    ("pddl", "dedication", f"public domain dedication and {_L}", "1(?: 0)?"),
    ("ogl", "government", f"open government {_L}", "[123](?: 0)?"),
    ("cdla", "agreement", f"community data {_L} agreement", "[12](?: 0)?"),
    ("cc-by-nc-nd", "nc", "(?:cc|creative commons) by nc nd", "[1-4](?: [05])?"),
    ("cc-by-nc-sa", "nc", "(?:cc|creative commons) by nc sa", "[1-4](?: [05])?"),
    ("cc-by-nc", "nc", "(?:cc|creative commons) by nc", "[1-4](?: [05])?"),
    ("cc-by-nd", "nd", "(?:cc|creative commons) by nd", "[1-4](?: [05])?"),
    ("cc-by-sa", "sa", "(?:cc|creative commons) by sa", "[1-4](?: [05])?"),
    ("cc-by", "cc", "cc by", "[1-4](?: [05])?"),
    ("cc-by-nc-sa", "creative", "creative commons attribution non ?commercial share ?alike", "[1-4](?: [05])?"),
    ("cc-by-nc-nd", "creative", "creative commons attribution non ?commercial no ?derivatives", "[1-4](?: [05])?"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike", "[1-4](?: [05])?"),
    ("cc-by-nd", "creative", "creative commons attribution no ?derivatives", "[1-4](?: [05])?"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial", "[1-4](?: [05])?"),
    ("cc-by", "creative", "creative commons attribution", "[1-4](?: [05])?"),
    ("cc0", "cc0", "cc0", "1(?: 0)?"),
    ("cc0", "universal", "cc0 1 0 universal", ""),
    ("public-domain", "domain", "public domain", ""),
    ("proprietary", "reserved", "all rights reserved", ""),
]

# label, keyword, signature of a licence's own wording
BODIES = [
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("apache", "apache", f"licensed under the apache {_L} version 2 0 the {_L} you may not use this file"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "redistribute", f"you can redistribute it and or modify it under the terms of the gnu general public {_L}"),
    ("lgpl", "redistribute", f"you can redistribute it and or modify it under the terms of the gnu lesser general public {_L}"),
    ("agpl", "redistribute", f"you can redistribute it and or modify it under the terms of the gnu affero general public {_L}"),
    ("mpl", "mozilla", f"subject to the terms of the mozilla public {_L}"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("boost", "permission", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", "implied", "this software is provided as is without any express or implied warranty"),
    ("cc-by", "creative", f"this work is licensed under a creative commons attribution(?: \\d \\d)?(?: international)? {_L}"),
    ("wtfpl", "want", "do what the fuck you want to public"),
]

_LATER = "(?: or (?:any )?later(?: version)?| only)?"

# label, keyword, pattern: the version is part of the word, "GPLv2.1" being gplv2 1
JOINED = [
    ("gpl", "gplv1", "gplv1(?: 0)?"),
    ("gpl", "gplv2", "gplv2(?: 0)?"),
    ("gpl", "gplv3", "gplv3(?: 0)?"),
    ("gpl", "gpl2", "gpl2(?: 0)?"),
    ("gpl", "gpl3", "gpl3(?: 0)?"),
    ("lgpl", "lgplv2", "lgplv2(?: [01])?"),
    ("lgpl", "lgplv3", "lgplv3(?: 0)?"),
    ("lgpl", "lgpl2", "lgpl2(?: [01])?"),
    ("lgpl", "lgpl3", "lgpl3(?: 0)?"),
    ("lgpl", "lgpl21", "lgpl21"),
    ("agpl", "agplv3", "agplv3(?: 0)?"),
    ("agpl", "agpl3", "agpl3(?: 0)?"),
    ("gfdl", "gfdlv1", "gfdlv1(?: [123])?"),
    ("apache", "apache2", "apache2(?: 0)?(?: licen[sc]ed?)?"),
    ("apache", "apachev2", "apachev2(?: 0)?(?: licen[sc]ed?)?"),
    ("apache", "apache20", "apache20"),
    ("apache", "asl2", "asl2(?: 0)?"),
    ("apache", "alv2", "alv2"),
    ("mpl", "mplv1", "mplv1(?: [01])?"),
    ("mpl", "mplv2", "mplv2(?: 0)?"),
    ("mpl", "mpl2", "mpl2(?: 0)?"),
    ("mpl", "mpl11", "mpl11"),
    ("epl", "eplv1", "eplv1(?: 0)?"),
    ("epl", "eplv2", "eplv2(?: 0)?"),
    ("epl", "epl2", "epl2(?: 0)?"),
    ("cddl", "cddlv1", "cddlv1(?: [01])?"),
    ("eupl", "euplv1", "euplv1(?: [012])?"),
    ("bsd-2-clause", "bsd2", f"bsd2(?: clause)?(?: {_L})?"),
    ("bsd-3-clause", "bsd3", f"bsd3(?: clause)?(?: {_L})?"),
    ("bsd-4-clause", "bsd4", f"bsd4(?: clause)?(?: {_L})?"),
    ("boost", "bsl1", "bsl1 0"),
    ("artistic", "artistic2", "artistic2(?: 0)?"),
    ("cc-by", "ccby", "ccby(?: [1-4](?: [05])?)?"),
    ("cc-by", "by4", "cc by4(?: 0)?"),
    ("cc-by", "by3", "cc by3(?: 0)?"),
    ("cc-by-sa", "ccbysa", "ccbysa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc", "ccbync", "ccbync(?: [1-4](?: [05])?)?"),
    ("cc-by-nd", "ccbynd", "ccbynd(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-sa", "ccbyncsa", "ccbyncsa(?: [1-4](?: [05])?)?"),
    ("cc-by-nc-nd", "ccbyncnd", "ccbyncnd(?: [1-4](?: [05])?)?"),
    ("cc-by-sa", "sa4", "cc by sa4(?: 0)?"),
    ("cc-by-nc", "nc4", "cc by nc4(?: 0)?"),
    ("odbl", "odblv1", "odblv1(?: 0)?"),
    ("sspl", "ssplv1", "ssplv1(?: 0)?"),
    ("ofl", "oflv1", "oflv1(?: [01])?"),
    ("wtfpl", "wtfplv2", "wtfplv2"),
    ("osl", "oslv3", "oslv3(?: 0)?"),
    ("afl", "aflv3", "aflv3(?: 0)?"),
    ("upl", "uplv1", "uplv1(?: 0)?"),
]

# weight of a detection by tier: body or tag, grant, versioned name, bare name
WEIGHTS = [1.0, 0.9, 0.8, 0.6]

_GRANT = ("(?:licensed|released|distributed|published|available|covered|provided|redistributed|used) "
          "(?:by|under|in accordance with|subject to) (?:the )?(?:terms of )?(?:the |an? )?")
_TAG = "(?:spdx )?licen[sc]e identifier |licen[sc]e (?:is )?(?:type )?"


def rules() -> list[tuple[int, int, str, str, str]]:
    """(index, tier, label, keyword, pattern), highest priority first."""
    out = [(0, label, kw, body) for label, kw, body in BODIES]
    for label, kw, name, version in FAMILIES:
        v = f"(?: (?:version |v ?)?{version})?(?: or (?:any )?later(?: version)?| only)?" if version else ""
        out.append((0, label, kw, f"(?:{_TAG})(?:{name}){v}"))
        out.append((1, label, kw, f"{_GRANT}(?:{name}){v}"))
        if version:
            out.append((2, label, kw, f"(?:{name}) (?:version |v ?)?{version}(?: or (?:any )?later(?: version)?| only)?"))
        out.append((3, label, kw, f"(?:{name})"))
    for label, kw, name in JOINED:
        out.append((0, label, kw, f"(?:{_TAG})(?:{name}){_LATER}"))
        out.append((1, label, kw, f"{_GRANT}(?:gnu )?(?:{name}){_LATER}"))
        out.append((2, label, kw, f"(?:gnu )?(?:{name}){_LATER}"))
    out.sort(key=lambda r: r[0])  # stable: order within a tier is as written
    return [(i, *r) for i, r in enumerate(out)]


def gate_words() -> list[str]:
    """Words of which a document must hold at least one."""
    return sorted({r[3] for r in rules()})
