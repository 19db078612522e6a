"""Signature rules for license scans, written by hand, in order.

One rule a line: label | priority | weight | keyword | pattern. Patterns run over text with A-Z in lower case; a space
in one stands for any run of white space, and gaps cross line feeds. The keyword is a plain part of every match: only
texts that hold it are tried. Priority 1 beats 5: tags and addresses (1), notices (2), names with versions (3), names
(4), mentions (5).
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    weight: float
    keyword: str
    pattern: str


RULES_TEXT = r"""
apache-2.0 | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: apache-2\.0
mit | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: mit\b
isc | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: isc\b
bsd-2-clause | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: bsd-2-clause
bsd-3-clause | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: bsd-3-clause
0bsd | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: 0bsd
gpl-2.0-only | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: gpl-2\.0(-only)?(?![-+\w])
gpl-2.0-or-later | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: gpl-2\.0(\+|-or-later)
gpl-3.0-only | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: gpl-3\.0(-only)?(?![-+\w])
gpl-3.0-or-later | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: gpl-3\.0(\+|-or-later)
lgpl-2.1-only | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: lgpl-2\.1(-only)?(?![-+\w])
lgpl-2.1-or-later | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: lgpl-2\.1(\+|-or-later)
lgpl-3.0-only | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: lgpl-3\.0(-only)?(?![-+\w])
lgpl-3.0-or-later | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: lgpl-3\.0(\+|-or-later)
agpl-3.0-only | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: agpl-3\.0(-only)?(?![-+\w])
agpl-3.0-or-later | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: agpl-3\.0(\+|-or-later)
mpl-2.0 | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: mpl-2\.0
epl-2.0 | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: epl-2\.0
cc0-1.0 | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: cc0-1\.0
unlicense | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: unlicense
zlib | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: zlib\b
bsl-1.0 | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: bsl-1\.0
wtfpl | 1 | 1.0 | spdx-license-identifier | spdx-license-identifier: wtfpl
spdx-other | 2 | 0.8 | spdx-license-identifier | spdx-license-identifier: [a-z0-9][a-z0-9.+-]*
apache-2.0 | 1 | 1.0 | apache.org/licenses | https?://(www\.)?apache\.org/licenses/license-2\.0(\.txt|\.html)?
apache-1.1 | 1 | 1.0 | apache.org/licenses | https?://(www\.)?apache\.org/licenses/license-1\.1
apache | 3 | 0.9 | apache.org/licenses | https?://(www\.)?apache\.org/licenses/?
gpl-2.0 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/(old-licenses/)?gpl-2\.0
gpl-3.0 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/gpl-3\.0
lgpl-2.1 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/(old-licenses/)?lgpl-2\.1
lgpl-3.0 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/lgpl-3\.0
agpl-3.0 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/agpl(-3\.0)?
gfdl-1.3 | 1 | 1.0 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/fdl(-1\.3)?
gnu | 3 | 0.8 | gnu.org/licenses | https?://(www\.)?gnu\.org/licenses/?
mit | 1 | 1.0 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/mit(-license)?\b
bsd-2-clause | 1 | 1.0 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/bsd-2-clause
bsd-3-clause | 1 | 1.0 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/bsd-3-clause
isc | 1 | 1.0 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/isc\b
artistic-2.0 | 1 | 1.0 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/artistic-2\.0
osi-other | 3 | 0.7 | opensource.org/licenses | https?://(www\.)?opensource\.org/licenses/[a-z0-9.-]+
mpl-2.0 | 1 | 1.0 | mozilla.org | https?://(www\.)?mozilla\.org/(en-us/)?mpl/2\.0
mpl-1.1 | 1 | 1.0 | mozilla.org | https?://(www\.)?mozilla\.org/mpl/(mpl-)?1\.1
epl-2.0 | 1 | 1.0 | eclipse.org | https?://(www\.)?eclipse\.org/legal/epl-(v20|2\.0)
epl-1.0 | 1 | 1.0 | eclipse.org | https?://(www\.)?eclipse\.org/legal/epl-(v10|1\.0)
unlicense | 1 | 1.0 | unlicense.org | https?://(www\.)?unlicense\.org
bsl-1.0 | 1 | 1.0 | boost.org | https?://(www\.)?boost\.org/license_1_0\.txt
wtfpl | 1 | 1.0 | wtfpl.net | https?://(www\.)?wtfpl\.net
odbl-1.0 | 1 | 1.0 | opendatacommons.org | https?://(www\.)?opendatacommons\.org/licenses/odbl
odc-by-1.0 | 1 | 1.0 | opendatacommons.org | https?://(www\.)?opendatacommons\.org/licenses/by
pddl-1.0 | 1 | 1.0 | opendatacommons.org | https?://(www\.)?opendatacommons\.org/licenses/pddl
ofl-1.1 | 1 | 1.0 | scripts.sil.org | https?://scripts\.sil\.org/ofl
cc-by-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by/4\.0
cc-by-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by/3\.0
cc-by-2.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by/2\.[05]
cc-by-sa-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-sa/4\.0
cc-by-sa-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-sa/3\.0
cc-by-sa-2.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-sa/2\.[05]
cc-by-nc-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc/4\.0
cc-by-nc-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc/3\.0
cc-by-nc-sa-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc-sa/4\.0
cc-by-nc-sa-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc-sa/3\.0
cc-by-nc-nd-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc-nd/4\.0
cc-by-nc-nd-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nc-nd/3\.0
cc-by-nd-4.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nd/4\.0
cc-by-nd-3.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/licenses/by-nd/3\.0
cc0-1.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/publicdomain/zero/1\.0
cc-pdm-1.0 | 1 | 1.0 | creativecommons.org | https?://creativecommons\.org/publicdomain/mark/1\.0
cc-other | 3 | 0.7 | creativecommons.org | https?://(www\.)?creativecommons\.org/licenses/[a-z/+0-9.-]+
apache-2.0 | 2 | 1.0 | apache license | licensed under the apache license,? version 2\.0
apache-2.0 | 3 | 0.9 | apache license | apache license,? (version|v\.?) ?2(\.0)?\b
apache-2.0 | 3 | 0.9 | apache license | apache license 2(\.0)?\b
apache-1.1 | 3 | 0.9 | apache | apache (software )?license,? (version )?1\.1
apache-1.0 | 3 | 0.9 | apache | apache (software )?license,? (version )?1\.0
apache-2.0 | 3 | 0.9 | apache-2 | \bapache-2(\.0)?\b
apache-2.0 | 3 | 0.9 | apache 2 | \bapache 2(\.0)? licen[sc]ed?\b
apache-2.0 | 3 | 0.8 | asl 2 | \basl 2\.0\b
apache | 4 | 0.7 | apache | \bapache (software )?licen[sc]e\b
apache-2.0 | 2 | 1.0 | except in compliance | you may not use this file except in compliance with the license
apache | 2 | 1.0 | apache software foundation | licensed to the apache software foundation \(asf\)
mit | 2 | 1.0 | mit license | (released|licensed|distributed|available|published|provided) under (the )?(terms of the )?mit licen[sc]e
mit | 4 | 0.8 | mit license | \b(the )?mit licen[sc]e\b
mit | 4 | 0.8 | mit licence | \b(the )?mit licence\b
mit | 4 | 0.8 | mit-licensed | \bmit-licensed\b
mit | 4 | 0.8 | license: mit | \blicense: mit\b
mit | 4 | 0.7 | expat | \bexpat licen[sc]e\b
mit | 2 | 1.0 | permission is hereby granted | permission is hereby granted, free of charge, to any person obtaining a copy of this software
mit | 2 | 0.9 | shall be included | the above copyright notice and this permission notice shall be included in all copies
mit-0 | 3 | 0.9 | mit no attribution | \bmit no attribution\b
mit-0 | 3 | 0.9 | mit-0 | \bmit-0\b
x11 | 4 | 0.8 | x11 licen | \bx11 licen[sc]e\b
isc | 4 | 0.8 | isc licen | \bisc licen[sc]e\b
isc | 2 | 0.9 | permission to use, copy | permission to use, copy, modify,? and(/or)? distribute this software for any purpose
bsd-2-clause | 3 | 0.9 | bsd | \b(bsd[- ]2[- ]clause|2[- ]clause bsd)( licen[sc]e)?\b
bsd-3-clause | 3 | 0.9 | bsd | \b(bsd[- ]3[- ]clause|3[- ]clause bsd)( licen[sc]e)?\b
bsd-4-clause | 3 | 0.9 | bsd | \b(bsd[- ]4[- ]clause|4[- ]clause bsd)( licen[sc]e)?\b
bsd-2-clause | 3 | 0.9 | bsd | \b(simplified|freebsd) bsd licen[sc]e\b
bsd-3-clause | 3 | 0.9 | bsd | \b(new|modified|revised) bsd licen[sc]e\b
bsd-4-clause | 3 | 0.9 | bsd | \b(original|old) bsd licen[sc]e\b
0bsd | 3 | 0.9 | bsd | \b(0bsd|bsd zero clause( licen[sc]e)?|zero-clause bsd)\b
bsd | 4 | 0.7 | bsd | \bbsd(-style)? licen[sc]ed?\b
bsd | 2 | 0.9 | redistribution and use | redistribution and use in source and binary forms, with or without modification, are permitted
bsd-3-clause | 2 | 0.9 | endorse or promote | neither the name of [\s\S]{1,300}? may be used to endorse or promote products
bsd-4-clause | 2 | 0.9 | advertising materials | all advertising materials mentioning features or use of this software
bsd | 5 | 0.6 | "as is" | this software is provided by [\s\S]{1,300}? "as is"
gpl-3.0 | 2 | 1.0 | general public license | licensed under the gnu general public license,? (version |v\.?)3(\.0)?\b
gpl-2.0 | 2 | 1.0 | general public license | licensed under the gnu general public license,? (version |v\.?)2(\.0)?\b
gpl-3.0-or-later | 2 | 1.0 | general public license | gnu general public license\b\s*[\s\S]{0,120}?(either )?version 3(\.0)?( of the license)?,? or \(?at your option\)? any later version
gpl-2.0-or-later | 2 | 1.0 | general public license | gnu general public license\b\s*[\s\S]{0,120}?(either )?version 2(\.0)?( of the license)?,? or \(?at your option\)? any later version
gpl-3.0 | 3 | 0.9 | general public license | gnu general public license,? (version |v\.?)3(\.0)?\b
gpl-2.0 | 3 | 0.9 | general public license | gnu general public license,? (version |v\.?)2(\.0)?\b
gpl-1.0 | 3 | 0.9 | general public license | gnu general public license,? (version |v\.?)1(\.0)?\b
lgpl-3.0 | 3 | 0.9 | lesser general public | gnu lesser general public licen[sc]e,? (version |v\.?)3(\.0)?\b
lgpl-2.1 | 3 | 0.9 | lesser general public | gnu lesser general public licen[sc]e,? (version |v\.?)2\.1\b
lgpl-2.0 | 3 | 0.9 | library general public | gnu library general public licen[sc]e(,? (version |v\.?)2(\.0)?)?\b
agpl-3.0 | 3 | 0.9 | affero general public | gnu affero general public licen[sc]e,? (version |v\.?)3(\.0)?\b
lgpl | 4 | 0.8 | lesser general public | \b(gnu )?lesser general public licen[sc]e\b
agpl | 4 | 0.8 | affero general public | \b(gnu )?affero general public licen[sc]e\b
gpl | 4 | 0.8 | general public licen | \b(gnu )?general public licen[sc]e\b
gpl-3.0 | 3 | 0.9 | gpl | \b(gnu )?gplv?[- ]?3(\.0)?(?![-+\w]|\.\d)
gpl-3.0-or-later | 3 | 0.9 | gpl | \b(gnu )?gplv?[- ]?3(\.0)?(\+|-or-later| or later)
gpl-2.0 | 3 | 0.9 | gpl | \b(gnu )?gplv?[- ]?2(\.0)?(?![-+\w]|\.\d)
gpl-2.0-or-later | 3 | 0.9 | gpl | \b(gnu )?gplv?[- ]?2(\.0)?(\+|-or-later| or later)
lgpl-3.0 | 3 | 0.9 | lgpl | \blgplv?[- ]?3(\.0)?(?![-+\w]|\.\d)
lgpl-3.0-or-later | 3 | 0.9 | lgpl | \blgplv?[- ]?3(\.0)?(\+|-or-later| or later)
lgpl-2.1 | 3 | 0.9 | lgpl | \blgplv?[- ]?2\.1(?![-+\w]|\.\d)
lgpl-2.1-or-later | 3 | 0.9 | lgpl | \blgplv?[- ]?2\.1(\+|-or-later| or later)
agpl-3.0 | 3 | 0.9 | agpl | \bagplv?[- ]?3(\.0)?(?![-+\w]|\.\d)
agpl-3.0-or-later | 3 | 0.9 | agpl | \bagplv?[- ]?3(\.0)?(\+|-or-later| or later)
lgpl | 5 | 0.6 | lgpl | \blgpl\b
agpl | 5 | 0.6 | agpl | \bagpl\b
gpl | 5 | 0.6 | gpl | \b(gnu )?gpl\b
gpl | 5 | 0.6 | gnu public | \bgnu public licen[sc]e\b
gpl-classpath | 3 | 0.9 | classpath | \b(gnu )?classpath[- ]exception\b
gcc-exception | 3 | 0.9 | gcc runtime | \bgcc runtime library exception\b
gfdl-1.3 | 3 | 0.9 | free documentation | gnu free documentation licen[sc]e,? (version |v\.?)1\.3\b
gfdl-1.2 | 3 | 0.9 | free documentation | gnu free documentation licen[sc]e,? (version |v\.?)1\.2\b
gfdl | 4 | 0.8 | free documentation | \b(gnu )?free documentation licen[sc]e\b
gfdl | 5 | 0.6 | gfdl | \bgfdl\b
no-warranty | 5 | 0.3 | without any warranty | without any warranty; without even the implied warranty
mpl-2.0 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e,? (version |v\.? ?)2(\.0)?\b
mpl-1.1 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e,? (version |v\.? ?)1\.1\b
mpl-1.0 | 3 | 0.9 | mozilla public | mozilla public licen[sc]e,? (version |v\.? ?)1\.0\b
mpl | 4 | 0.8 | mozilla public | \bmozilla public licen[sc]e\b
mpl-2.0 | 3 | 0.9 | mpl | \bmpl[- ]?2(\.0)?\b
mpl-1.1 | 3 | 0.9 | mpl | \bmpl[- ]?1\.1\b
epl-2.0 | 3 | 0.9 | eclipse public | eclipse public licen[sc]e(,? (version |v\.? ?)| - v ?)2(\.0)?\b
epl-1.0 | 3 | 0.9 | eclipse public | eclipse public licen[sc]e(,? (version |v\.? ?)| - v ?)1(\.0)?\b
epl | 4 | 0.8 | eclipse public | \beclipse public licen[sc]e\b
edl-1.0 | 4 | 0.8 | eclipse distribution | \beclipse distribution licen[sc]e\b
cddl-1.1 | 3 | 0.9 | common development and distribution | common development and distribution licen[sc]e,? (version |v\.? ?)1\.1
cddl-1.0 | 3 | 0.9 | common development and distribution | common development and distribution licen[sc]e,? (version |v\.? ?)1\.0
cddl | 4 | 0.8 | common development and distribution | \bcommon development and distribution licen[sc]e\b
cddl | 5 | 0.6 | cddl | \bcddl\b
cpl-1.0 | 4 | 0.8 | common public | \bcommon public licen[sc]e\b
cpal-1.0 | 4 | 0.8 | common public attribution | \bcommon public attribution licen[sc]e\b
eupl-1.2 | 3 | 0.9 | european union public | european union public licen[sc]e,? (version |v\.? ?)1\.2
eupl-1.1 | 3 | 0.9 | european union public | european union public licen[sc]e,? (version |v\.? ?)1\.1
eupl | 4 | 0.8 | european union public | \beuropean union public licen[sc]e\b
eupl | 5 | 0.6 | eupl | \beupl\b
bsl-1.0 | 3 | 0.9 | boost software | boost software licen[sc]e( -|,)? (version |v\.? ?)1\.0
bsl | 4 | 0.8 | boost software | \bboost software licen[sc]e\b
busl-1.1 | 3 | 0.9 | business source | business source licen[sc]e,? (version |v\.? ?)?1\.1
busl | 4 | 0.8 | business source | \bbusiness source licen[sc]e\b
sspl-1.0 | 4 | 0.9 | server side public | \bserver side public licen[sc]e\b
sspl-1.0 | 5 | 0.6 | sspl | \bsspl\b
elastic-2.0 | 3 | 0.9 | elastic licen | \belastic licen[sc]e,? (version |v\.? ?)?2(\.0)?\b
elastic | 4 | 0.8 | elastic licen | \belastic licen[sc]e\b
commons-clause | 4 | 0.9 | commons clause | \bcommons clause\b
polyform | 4 | 0.9 | polyform | \bpolyform (noncommercial|small business|shield|strict|perimeter|free trial) licen[sc]e\b
artistic-2.0 | 3 | 0.9 | artistic licen | \bartistic licen[sc]e,? (version |v\.? ?)?2(\.0)?\b
artistic-1.0 | 3 | 0.9 | artistic licen | \bartistic licen[sc]e,? (version |v\.? ?)?1(\.0)?\b
artistic | 4 | 0.8 | artistic licen | \bartistic licen[sc]e\b
perl | 4 | 0.8 | as perl itself | under the same terms as perl itself
python-2.0 | 4 | 0.8 | python software foundation | \bpython software foundation licen[sc]e\b
php-3.01 | 3 | 0.9 | php license | \bphp license,? (version |v\.? ?)3\.01\b
php | 4 | 0.8 | php license | \bphp license\b
ruby | 4 | 0.8 | ruby license | \bruby license\b
zlib | 4 | 0.8 | zlib | \bzlib(/libpng)? licen[sc]e\b
libpng | 4 | 0.8 | libpng | \blibpng licen[sc]e\b
openssl | 4 | 0.8 | openssl licen | \bopenssl licen[sc]e\b
curl | 4 | 0.8 | curl licen | \bcurl licen[sc]e\b
ntp | 4 | 0.8 | ntp licen | \bntp licen[sc]e\b
postgresql | 4 | 0.8 | postgresql licen | \bpostgresql licen[sc]e\b
vim | 4 | 0.8 | vim licen | \bvim licen[sc]e\b
ncsa | 4 | 0.8 | ncsa | \b(university of illinois/)?ncsa open source licen[sc]e\b
upl-1.0 | 4 | 0.8 | universal permissive | \buniversal permissive licen[sc]e\b
afl-3.0 | 4 | 0.8 | academic free | \bacademic free licen[sc]e\b
osl-3.0 | 4 | 0.8 | open software licen | \bopen software licen[sc]e\b
ms-pl | 4 | 0.8 | microsoft public | \bmicrosoft public licen[sc]e\b
ms-rl | 4 | 0.8 | microsoft reciprocal | \bmicrosoft reciprocal licen[sc]e\b
ecl-2.0 | 4 | 0.8 | educational community | \beducational community licen[sc]e\b
ofl-1.1 | 3 | 0.9 | open font | \b(sil )?open font licen[sc]e,? (version |v\.? ?)1\.1
ofl | 4 | 0.8 | open font | \b(sil )?open font licen[sc]e\b
lppl | 4 | 0.8 | latex project | \blatex project public licen[sc]e\b
cecill | 4 | 0.8 | cecill | \bcecill(-[abc])?\b
mulan-2.0 | 4 | 0.8 | mulan | \bmulan (psl|permissive software licen[sc]e)( v2)?
wtfpl | 4 | 0.9 | what the fuck | do what the fuck you want to public licen[sc]e
wtfpl | 5 | 0.6 | wtfpl | \bwtfpl\b
beerware | 4 | 0.8 | beer | \bbeer-?ware licen[sc]e\b
unlicense | 4 | 0.8 | unlicense | \bthe unlicense\b
unlicense | 2 | 1.0 | unencumbered | this is free and unencumbered software released into the public domain
public-domain | 4 | 0.8 | public domain | (released|placed|dedicated|put) (in|into|to) the public domain
public-domain | 5 | 0.5 | public domain | \b(in the )?public domain\b
odbl-1.0 | 4 | 0.8 | open database licen | \b(odc )?open database licen[sc]e\b
odbl-1.0 | 5 | 0.6 | odbl | \bodbl\b
odc-by-1.0 | 4 | 0.8 | open data commons | \bopen data commons attribution licen[sc]e\b
pddl-1.0 | 4 | 0.8 | public domain dedication and | \bpublic domain dedication and licen[sc]e\b
ogl-uk-3.0 | 4 | 0.8 | open government | \bopen government licen[sc]e( v?3(\.0)?)?\b
etalab-2.0 | 4 | 0.8 | licence ouverte | \blicence ouverte\b
openrail | 4 | 0.8 | openrail | \b(creativeml )?openrail(\+\+)?(-[ms])?\b
llama | 4 | 0.8 | llama | \bllama \d(\.\d)? community licen[sc]e\b
cc-by-nc-nd-4.0 | 3 | 0.9 | cc | \bcc[- ]by-nc-nd[- ]4\.0\b
cc-by-nc-sa-4.0 | 3 | 0.9 | cc | \bcc[- ]by-nc-sa[- ]4\.0\b
cc-by-nc-4.0 | 3 | 0.9 | cc | \bcc[- ]by-nc[- ]4\.0\b
cc-by-nd-4.0 | 3 | 0.9 | cc | \bcc[- ]by-nd[- ]4\.0\b
cc-by-sa-4.0 | 3 | 0.9 | cc | \bcc[- ]by-sa[- ]4\.0\b
cc-by-4.0 | 3 | 0.9 | cc | \bcc[- ]by[- ]4\.0\b
cc-by-nc-nd-3.0 | 3 | 0.9 | cc | \bcc[- ]by-nc-nd[- ]3\.0\b
cc-by-nc-sa-3.0 | 3 | 0.9 | cc | \bcc[- ]by-nc-sa[- ]3\.0\b
cc-by-nc-3.0 | 3 | 0.9 | cc | \bcc[- ]by-nc[- ]3\.0\b
cc-by-nd-3.0 | 3 | 0.9 | cc | \bcc[- ]by-nd[- ]3\.0\b
cc-by-sa-3.0 | 3 | 0.9 | cc | \bcc[- ]by-sa[- ]3\.0\b
cc-by-3.0 | 3 | 0.9 | cc | \bcc[- ]by[- ]3\.0\b
cc-by-nc-nd | 4 | 0.8 | cc | \bcc[- ]by-nc-nd\b
cc-by-nc-sa | 4 | 0.8 | cc | \bcc[- ]by-nc-sa\b
cc-by-nc | 4 | 0.8 | cc | \bcc[- ]by-nc\b
cc-by-nd | 4 | 0.8 | cc | \bcc[- ]by-nd\b
cc-by-sa | 4 | 0.8 | cc | \bcc[- ]by-sa\b
cc0-1.0 | 4 | 0.8 | cc0 | \bcc0( ?1\.0)?( universal)?\b
cc-by-nc-nd | 3 | 0.9 | attribution-noncommercial-noderiv | attribution-noncommercial-noderiv(ative)?s( \d\.\d)?( international)?
cc-by-nc-sa | 3 | 0.9 | attribution-noncommercial-sharealike | attribution-noncommercial-sharealike( \d\.\d)?( international)?
cc-by-nc | 4 | 0.8 | attribution-noncommercial | attribution-noncommercial( \d\.\d)?( international)?
cc-by-sa | 4 | 0.8 | attribution-sharealike | attribution-sharealike( \d\.\d)?( international)?
cc-by-nd | 4 | 0.8 | attribution-noderiv | attribution-noderiv(ative)?s( \d\.\d)?( international)?
cc-by | 4 | 0.8 | creative commons attribution | creative commons attribution( \d\.\d)?( international)?( licen[sc]e)?
cc-other | 5 | 0.6 | creative commons | \bcreative commons( licen[sc]e)?\b
proprietary | 2 | 0.9 | proprietary and confidential | \bproprietary and confidential\b
proprietary | 2 | 0.9 | strictly prohibited | unauthori[sz]ed (copying|use|reproduction|distribution) [\s\S]{1,300}? strictly prohibited
proprietary | 4 | 0.7 | end user licen | \bend user licen[sc]e agreement\b
proprietary | 4 | 0.6 | proprietary licen | \bproprietary licen[sc]e\b
no-derivatives | 5 | 0.5 | may not be reproduced | may not be reproduced\b\s*[\s\S]{0,300}?without [\s\S]{0,120}?permission
reserved | 4 | 0.6 | all rights reserved | (copyright|©|\(c\))[\s\S]{0,300}?all rights reserved
copyright | 5 | 0.4 | copyright | copyright (\(c\)|©)? ?(19|20)\d\d
dual-license | 5 | 0.5 | dual | \bdual[- ]licen[sc]ed\b
license-file | 5 | 0.4 | see license | see (the )?licen[sc]e file
license-ref | 5 | 0.3 | licensed under | \blicensed under (the )?
"""


def rules() -> list[Rule]:
    out = []
    for line in RULES_TEXT.strip().splitlines():
        label, priority, weight, keyword, pattern = (x.strip() for x in line.split(" | ", 4))
        out.append(Rule(label, int(priority), float(weight), keyword, pattern.replace("[- ]", r"[-\s]").replace(" ", r"\s+")))
    return out
