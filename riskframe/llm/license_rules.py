"""Hand-written licence signatures over normalised text (lower-case words, one space between them).

One rule a line: label, priority, keyword, regex. A rule is tried on texts that
contain its keyword. Priority 3: a licence's own text or an identifier; 2: a
named licence with its version, or a notice; 1: a name alone, which the longer
rules around it suppress.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    pattern: str


RULES_TEXT = r"""
mit | 3 | any person obtaining | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | 3 | associated documentation | the software and associated documentation files the software to deal in the software without restriction
mit | 3 | copies or substantial portions | the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | 2 | mit licen | (?:released|licensed|distributed|available|published|provided) (?:under|by) (?:the )?(?:terms of the )?mit licen[cs]e
mit | 2 | mit licen | the mit licen[cs]e mit
mit | 3 | spdx | spdx license identifier mit
mit | 2 | opensource org licenses mit | opensource org licenses mit(?: license)?
mit | 1 | mit licen | mit licen[cs]ed?
mit | 1 | expat licen | expat licen[cs]e
mit-0 | 3 | spdx | spdx license identifier mit 0
mit-0 | 2 | mit no attribution | mit no attribution(?: license)?
x11 | 2 | x11 licen | (?:the )?x11 licen[cs]e
x11 | 3 | x consortium | except as contained in this notice the name of the x consortium shall not be used
isc | 3 | permission to use copy | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc | 3 | spdx | spdx license identifier isc
isc | 2 | isc licen | (?:under|by) the isc licen[cs]e
isc | 1 | isc licen | isc licen[cs]e
0bsd | 3 | spdx | spdx license identifier 0bsd
0bsd | 2 | 0bsd | (?:bsd zero clause|0bsd) licen[cs]e
bsd-2-clause | 3 | spdx | spdx license identifier bsd 2 clause
bsd-2-clause | 2 | bsd | (?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd) licen[cs]e
bsd-2-clause | 1 | bsd 2 clause | bsd 2 clause
bsd-3-clause | 3 | spdx | spdx license identifier bsd 3 clause
bsd-3-clause | 3 | neither the name of | neither the name of .{1,80}? nor the names of its contributors may be used to endorse or promote products
bsd-3-clause | 2 | bsd | (?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd) licen[cs]e
bsd-3-clause | 1 | bsd 3 clause | bsd 3 clause
bsd-4-clause | 3 | spdx | spdx license identifier bsd 4 clause
bsd-4-clause | 3 | all advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd-4-clause | 2 | bsd | (?:bsd 4 clause|4 clause bsd|original bsd) licen[cs]e
bsd | 3 | redistribution and use | redistribution and use in source and binary forms with or without modification are permitted
bsd | 2 | redistributions of source | redistributions of source code must retain the above copyright notice
bsd | 2 | redistributions in binary | redistributions in binary form must reproduce the above copyright notice
bsd | 2 | bsd style | bsd style licen[cs]e
bsd | 1 | bsd licen | bsd licen[cs]ed?
apache-1.0 | 3 | spdx | spdx license identifier apache 1 0
apache-1.0 | 2 | apache | apache (?:software )?licen[cs]e (?:version )?1 0
apache-1.1 | 3 | spdx | spdx license identifier apache 1 1
apache-1.1 | 2 | apache | apache (?:software )?licen[cs]e (?:version )?1 1
apache-2.0 | 3 | spdx | spdx license identifier apache 2 0
apache-2.0 | 3 | apache license | licensed under the apache license version 2 0(?: the license)?
apache-2.0 | 3 | apache org licenses | (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2.0 | 3 | version 2 0 january 2004 | apache license version 2 0 january 2004
apache-2.0 | 3 | express or implied | distributed on an as is basis without warranties or conditions of any kind either express or implied
apache-2.0 | 2 | apache | apache (?:software )?licen[cs]e (?:v |v|version )?2(?: 0)?
apache-2.0 | 2 | asl 2 0 | asl 2 0
apache | 1 | apache licen | apache (?:software )?licen[cs]ed?
gpl-1.0 | 3 | spdx | spdx license identifier gpl 1 0(?: only| or later)?
gpl-1.0 | 2 | general public licen | gnu general public licen[cs]e (?:v|version )1(?: 0)?
gpl-2.0-only | 3 | spdx | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | 3 | spdx | spdx license identifier gpl 2 0 or later
gpl-2.0-or-later | 3 | either version 2 | gnu general public licen[cs]e as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0 | 3 | version 2 june 1991 | gnu general public license version 2 june 1991
gpl-2.0 | 2 | general public licen | (?:gnu )?general public licen[cs]e (?:v |v|version )?2(?: 0)?
gpl-2.0 | 2 | gpl | (?:gnu )?gpl ?v?2(?: 0)?
gpl-3.0-only | 3 | spdx | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | 3 | spdx | spdx license identifier gpl 3 0 or later
gpl-3.0-or-later | 3 | either version 3 | gnu general public licen[cs]e as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0 | 3 | version 3 29 june 2007 | gnu general public license version 3 29 june 2007
gpl-3.0 | 2 | general public licen | (?:gnu )?general public licen[cs]e (?:v |v|version )?3(?: 0)?
gpl-3.0 | 2 | gpl | (?:gnu )?gpl ?v?3(?: 0)?
gpl | 2 | free software foundation | you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e
gpl | 2 | received a copy of | you should have received a copy of the gnu general public licen[cs]e
gpl | 2 | www gnu org licenses gpl | www gnu org licenses gpl(?: html)?
gpl | 1 | general public licen | (?:gnu )?general public licen[cs]e
gpl | 1 | gnu gpl | gnu gpl
lgpl-2.0 | 3 | spdx | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.0 | 2 | library general public | gnu library general public licen[cs]e(?: version 2(?: 0)?)?
lgpl-2.1 | 3 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1 | 3 | february 1999 | gnu lesser general public license version 2 1 february 1999
lgpl-2.1 | 2 | lesser general public | (?:gnu )?lesser general public licen[cs]e (?:v |v|version )?2 1
lgpl-2.1 | 2 | lgpl | (?:gnu )?lgpl ?v?2 1
lgpl-3.0 | 3 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
lgpl-3.0 | 2 | lesser general public | (?:gnu )?lesser general public licen[cs]e (?:v |v|version )?3(?: 0)?
lgpl-3.0 | 2 | lgpl | (?:gnu )?lgpl ?v?3(?: 0)?
lgpl | 2 | lesser general public | under the terms of the gnu lesser general public licen[cs]e
lgpl | 2 | www gnu org licenses lgpl | www gnu org licenses lgpl(?: html)?
lgpl | 2 | lesser general public | (?:gnu )?lesser general public licen[cs]e
lgpl | 1 | gnu lgpl | gnu lgpl
agpl-3.0 | 3 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
agpl-3.0 | 3 | 19 november 2007 | gnu affero general public license version 3 19 november 2007
agpl-3.0 | 2 | affero general public | (?:gnu )?affero general public licen[cs]e (?:v |v|version )?3(?: 0)?
agpl-3.0 | 2 | agpl | (?:gnu )?agpl ?v?3(?: 0)?
agpl | 2 | affero general public | (?:gnu )?affero general public licen[cs]e
agpl | 1 | gnu agpl | gnu agpl
gfdl-1.1 | 2 | free documentation licen | gnu free documentation licen[cs]e (?:v |v|version )1 1
gfdl-1.2 | 2 | free documentation licen | gnu free documentation licen[cs]e (?:v |v|version )1 2
gfdl-1.3 | 2 | free documentation licen | gnu free documentation licen[cs]e (?:v |v|version )1 3
gfdl | 1 | free documentation licen | (?:gnu )?free documentation licen[cs]e
classpath-exception | 3 | classpath exception | (?:with )?(?:the )?classpath exception(?: 2 0)?
classpath-exception | 3 | linking this library | linking this library statically or dynamically with other modules is making a combined work
gcc-exception | 2 | gcc runtime library | gcc runtime library exception(?: 3 1)?
font-exception | 2 | font exception | gpl font exception
mpl-1.0 | 3 | spdx | spdx license identifier mpl 1 0
mpl-1.0 | 2 | mozilla public licen | mozilla public licen[cs]e (?:v |v|version )?1 0
mpl-1.1 | 3 | spdx | spdx license identifier mpl 1 1
mpl-1.1 | 2 | mozilla public licen | mozilla public licen[cs]e (?:v |v|version )?1 1
mpl-2.0 | 3 | spdx | spdx license identifier mpl 2 0
mpl-2.0 | 3 | source code form is subject | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | 2 | mozilla public licen | mozilla public licen[cs]e (?:v |v|version )?2(?: 0)?
mpl-2.0 | 2 | mozilla org mpl | mozilla org mpl 2 0
mpl | 1 | mozilla public licen | mozilla public licen[cs]e
epl-1.0 | 3 | spdx | spdx license identifier epl 1 0
epl-1.0 | 2 | eclipse public licen | eclipse public licen[cs]e (?:v |v|version )?1(?: 0)?
epl-2.0 | 3 | spdx | spdx license identifier epl 2 0
epl-2.0 | 2 | eclipse public licen | eclipse public licen[cs]e (?:v |v|version )?2(?: 0)?
epl | 1 | eclipse public licen | eclipse public licen[cs]e
edl-1.0 | 2 | eclipse distribution licen | eclipse distribution licen[cs]e(?: v 1 0| v1 0| version 1 0)?
cpl-1.0 | 2 | common public licen | common public licen[cs]e(?: version 1 0| v1 0)?
ipl-1.0 | 2 | ibm public licen | ibm public licen[cs]e(?: version 1 0)?
cddl-1.0 | 3 | spdx | spdx license identifier cddl 1 0
cddl-1.0 | 2 | common development and distribution | common development and distribution licen[cs]e (?:cddl )?(?:v |v|version )?1 0
cddl-1.1 | 2 | common development and distribution | common development and distribution licen[cs]e (?:cddl )?(?:v |v|version )?1 1
cddl | 1 | common development and distribution | common development and distribution licen[cs]e
cpal-1.0 | 2 | common public attribution | common public attribution licen[cs]e(?: version 1 0)?
eupl-1.1 | 2 | european union public licen | european union public licen[cs]e (?:eupl )?(?:v |v|version )?1 1
eupl-1.2 | 3 | spdx | spdx license identifier eupl 1 2
eupl-1.2 | 2 | european union public licen | european union public licen[cs]e (?:eupl )?(?:v |v|version )?1 2
eupl | 1 | european union public licen | european union public licen[cs]e
osl-3.0 | 2 | open software licen | open software licen[cs]e (?:osl )?(?:v |v|version )?3(?: 0)?
osl | 1 | open software licen | open software licen[cs]e
afl-3.0 | 2 | academic free licen | academic free licen[cs]e (?:v |v|version )?3(?: 0)?
afl | 1 | academic free licen | academic free licen[cs]e
artistic-1.0 | 2 | artistic licen | artistic licen[cs]e (?:v |v|version )?1(?: 0)?
artistic-2.0 | 3 | spdx | spdx license identifier artistic 2 0
artistic-2.0 | 2 | artistic licen | artistic licen[cs]e (?:v |v|version )?2(?: 0)?
artistic | 1 | artistic licen | (?:perl )?artistic licen[cs]e
perl | 2 | same terms as perl | under the same terms as perl(?: itself)?
zlib | 3 | origin of this software | the origin of this software must not be misrepresented
zlib | 3 | spdx | spdx license identifier zlib
zlib | 2 | zlib | (?:zlib|zlib libpng|libpng) licen[cs]e
bsl-1.0 | 3 | spdx | spdx license identifier bsl 1 0
bsl-1.0 | 3 | boost software licen | boost software licen[cs]e version 1 0(?: 17th? august 2003| august 17th 2003)?
bsl-1.0 | 2 | boost software licen | boost software licen[cs]e
bsl-1.0 | 2 | boost org | (?:www )?boost org license 1 0 txt
busl-1.1 | 3 | spdx | spdx license identifier busl 1 1
busl-1.1 | 2 | business source licen | business source licen[cs]e(?: 1 1| version 1 1)?
sspl-1.0 | 3 | spdx | spdx license identifier sspl 1 0
sspl-1.0 | 2 | server side public licen | server side public licen[cs]e(?: v1| version 1)?
elastic-2.0 | 2 | elastic licen | elastic licen[cs]e (?:v |v|version )?2(?: 0)?
elastic | 1 | elastic licen | elastic licen[cs]e
unlicense | 3 | unencumbered software | this is free and unencumbered software released into the public domain
unlicense | 3 | spdx | spdx license identifier unlicense
unlicense | 2 | unlicense | (?:the unlicense|unlicense org)
wtfpl | 3 | spdx | spdx license identifier wtfpl
wtfpl | 2 | want to public licen | do what the \w+ you want to public licen[cs]e
wtfpl | 1 | wtfpl | wtfpl
cc0-1.0 | 3 | spdx | spdx license identifier cc0 1 0
cc0-1.0 | 3 | publicdomain zero | creativecommons org publicdomain zero 1 0
cc0-1.0 | 2 | cc0 | (?:creative commons )?cc0(?: 1 0)?(?: universal)?(?: public domain dedication)?
public-domain | 2 | public domain | (?:released|placed|dedicated|is) (?:in|into|to) the public domain
public-domain | 2 | public domain | public domain (?:dedication|mark|work|notice)
public-domain | 2 | publicdomain mark | creativecommons org publicdomain mark 1 0
cc-by-1.0 | 2 | cc by | cc by 1 0
cc-by-2.0 | 2 | cc by | cc by 2 0
cc-by-2.5 | 2 | cc by | cc by 2 5
cc-by-3.0 | 2 | cc by | cc by 3 0
cc-by-3.0 | 2 | creative commons attribution | creative commons attribution 3 0(?: unported| international)?(?: licen[cs]e)?
cc-by-4.0 | 3 | spdx | spdx license identifier cc by 4 0
cc-by-4.0 | 2 | cc by | cc by 4 0
cc-by-4.0 | 2 | creative commons attribution | creative commons attribution 4 0(?: international)?(?: public)?(?: licen[cs]e)?
cc-by-4.0 | 2 | creativecommons org | creativecommons org licenses by 4 0
cc-by | 1 | cc by | (?:creative commons )?cc by
cc-by | 1 | creative commons attribution | creative commons attribution(?: licen[cs]e)?
cc-by-sa-2.0 | 2 | cc by sa | cc by sa 2 0
cc-by-sa-2.5 | 2 | cc by sa | cc by sa 2 5
cc-by-sa-3.0 | 2 | cc by sa | cc by sa 3 0
cc-by-sa-3.0 | 2 | sharealike | creative commons attribution share ?alike 3 0(?: unported| international)?(?: licen[cs]e)?
cc-by-sa-4.0 | 3 | spdx | spdx license identifier cc by sa 4 0
cc-by-sa-4.0 | 2 | cc by sa | cc by sa 4 0
cc-by-sa-4.0 | 2 | creative commons attribution share | creative commons attribution share ?alike 4 0(?: international)?(?: licen[cs]e)?
cc-by-sa-4.0 | 2 | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa | 1 | cc by sa | cc by sa
cc-by-sa | 1 | creative commons attribution share | creative commons attribution share ?alike(?: licen[cs]e)?
cc-by-nc-2.0 | 2 | cc by nc | cc by nc 2 0
cc-by-nc-3.0 | 2 | cc by nc | cc by nc 3 0
cc-by-nc-4.0 | 3 | spdx | spdx license identifier cc by nc 4 0
cc-by-nc-4.0 | 2 | cc by nc | cc by nc 4 0
cc-by-nc-4.0 | 2 | noncommercial 4 0 | creative commons attribution non ?commercial 4 0(?: international)?(?: licen[cs]e)?
cc-by-nc-4.0 | 2 | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc | 1 | cc by nc | cc by nc
cc-by-nc-sa-3.0 | 2 | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa-4.0 | 3 | spdx | spdx license identifier cc by nc sa 4 0
cc-by-nc-sa-4.0 | 2 | cc by nc sa | cc by nc sa 4 0
cc-by-nc-sa-4.0 | 2 | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa | 1 | cc by nc sa | cc by nc sa
cc-by-nc-nd-3.0 | 2 | cc by nc nd | cc by nc nd 3 0
cc-by-nc-nd-4.0 | 3 | spdx | spdx license identifier cc by nc nd 4 0
cc-by-nc-nd-4.0 | 2 | cc by nc nd | cc by nc nd 4 0
cc-by-nc-nd-4.0 | 2 | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd | 1 | cc by nc nd | cc by nc nd
cc-by-nd-3.0 | 2 | cc by nd | cc by nd 3 0
cc-by-nd-4.0 | 2 | cc by nd | cc by nd 4 0
cc-by-nd-4.0 | 2 | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nd | 1 | cc by nd | cc by nd
creative-commons | 1 | creative commons | (?:a |the )?creative commons licen[cs]e
odbl-1.0 | 3 | spdx | spdx license identifier odbl 1 0
odbl-1.0 | 2 | open database licen | open (?:data commons open )?database licen[cs]e(?: odbl)?(?: v 1 0| v1 0| 1 0)?
odc-by-1.0 | 2 | open data commons attribution | open data commons attribution licen[cs]e(?: v 1 0| v1 0| 1 0)?
pddl-1.0 | 2 | public domain dedication and licen | (?:open data commons )?public domain dedication and licen[cs]e(?: pddl)?
cdla-permissive | 2 | community data licen | community data licen[cs]e agreement permissive(?: 1 0| 2 0| version 1 0| version 2 0)?
cdla-sharing | 2 | community data licen | community data licen[cs]e agreement sharing(?: 1 0| version 1 0)?
ogl-uk | 2 | open government licen | open government licen[cs]e(?: v3 0| v2 0| v1 0| version 3 0)?
etalab-2.0 | 2 | licence ouverte | licence ouverte(?: open licen[cs]e)?(?: version)?(?: 2 0)?
ofl-1.1 | 3 | spdx | spdx license identifier ofl 1 1
ofl-1.1 | 2 | open font licen | (?:sil )?open font licen[cs]e(?: version)?(?: 1 1)?
ufl-1.0 | 2 | ubuntu font licen | ubuntu font licen[cs]e(?: version 1 0)?
psf-2.0 | 3 | spdx | spdx license identifier (?:psf|python) 2 0(?: 1)?
psf-2.0 | 2 | python software foundation | python software foundation licen[cs]e(?: agreement)?(?: version 2)?
ruby | 2 | ruby licen | (?:the )?ruby licen[cs]e
php-3.01 | 2 | php licen | php licen[cs]e(?: version)?(?: 3 01| 3 0)?
openssl | 2 | openssl licen | openssl licen[cs]e
openssl | 3 | openssl toolkit | this product includes software developed by the openssl project for use in the openssl toolkit
curl | 2 | curl licen | curl licen[cs]e
ntp | 2 | ntp licen | ntp licen[cs]e
postgresql | 2 | postgresql licen | postgresql licen[cs]e
ncsa | 2 | ncsa | (?:university of illinois )?(?:uiuc )?ncsa open source licen[cs]e
w3c | 2 | w3c | w3c software (?:notice and )?(?:and document )?licen[cs]e
unicode | 2 | unicode | unicode(?: inc)? licen[cs]e(?: agreement)?(?: v3)?
vim | 2 | vim licen | vim licen[cs]e
tcl | 2 | tcl | tcl tk licen[cs]e
ms-pl | 2 | microsoft public licen | microsoft public licen[cs]e(?: ms pl)?
ms-rl | 2 | microsoft reciprocal licen | microsoft reciprocal licen[cs]e(?: ms rl)?
apsl-2.0 | 2 | apple public source | apple public source licen[cs]e(?: version)?(?: 2 0)?
bigscience-rail | 2 | bigscience | bigscience (?:bloom )?(?:open ?)?rail(?: m)?(?: licen[cs]e)?
openrail | 2 | openrail | (?:creativeml )?openrail(?: m| \+\+ m)?(?: licen[cs]e)?
llama | 2 | llama | llama (?:2|3|3 1|3 2|3 3) community licen[cs]e(?: agreement)?
gemma | 2 | gemma | gemma terms of use
beerware | 2 | beerware | (?:the )?beerware licen[cs]e
json | 3 | used for good not evil | the software shall be used for good not evil
commons-clause | 2 | commons clause | commons clause(?: licen[cs]e condition)?(?: v1 0)?
hippocratic | 2 | hippocratic licen | hippocratic licen[cs]e(?: 2 1| 3 0)?
polyform | 2 | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter) licen[cs]e(?: 1 0 0)?
proprietary | 2 | all rights reserved | all rights reserved
proprietary | 2 | proprietary and confidential | proprietary and confidential
proprietary | 2 | licen | unauthorized copying of this (?:file|software) via any medium is strictly prohibited
proprietary | 2 | end user licen | end user licen[cs]e agreement
proprietary | 2 | licen | this software is licensed not sold
no-warranty | 1 | merchantability | without (?:even the implied )?warranty of merchantability(?: or fitness for a particular purpose)?
no-warranty | 1 | as is without warranty | (?:provided )?as is without warranty of any kind(?: express or implied)?
copyright-notice | 1 | copyright | copyright (?:c |© )?(?:19|20)\d\d
"""


def parsed(text: str = RULES_TEXT) -> list[Rule]:
    rows = [[part.strip() for part in line.split(" | ")] for line in text.strip().splitlines()]
    return [Rule(label, int(priority), keyword, pattern) for label, priority, keyword, pattern in rows]


RULES = parsed()
#: Places of these phrases are counted, and their labels are never suppressed.
BASE = (("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license"))


#: Words of any prose, which tell nothing about a text.
COMMON = set(
    "all an and any are as at be by can copy data file for free from good have in is it its made may name no not of on open or "
    "org other out same source terms text that the this to under use used want was will with without work you your".split()
)


def needed_words(rule: Rule) -> set[str]:
    """Words, or their beginnings, that stand in every text the rule can match."""
    fixed = rule.pattern
    while (shorter := re.sub(r"\([^()]*\)\??", " ", fixed)) != fixed:
        fixed = shorter
    whole = re.sub(r"\b\w+\?|\[[^]]*\]\w*|\\\w|\.\{[^}]*\}\??", " ", fixed)
    words = {"licen"} if "licen" in fixed or "licen" in rule.keyword else set()
    return words | {w for w in {*whole.split(), *rule.keyword.split()} if len(w) > 1 and w.isalnum()} - COMMON


def gates() -> list[str]:
    """Few words of which every text that a rule or phrase can match holds at least one."""
    left, found = list(RULES), ["licen"]  # all base phrases have it
    left = [r for r in left if "licen" not in needed_words(r)]
    while left:
        count = Counter(w for r in left for w in needed_words(r))
        best = max(count, key=lambda w: (count[w], len(w), w))
        found.append(best)
        left = [r for r in left if best not in needed_words(r)]
    return found
