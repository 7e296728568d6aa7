"""Licence signatures: hand-written regexes over normalised text.

One rule per line: label ~ priority ~ keyword ~ regex.  The text they see is
lower-case words with one blank between them, so ``GPL-3.0-or-later`` reads
``gpl 3 0 or later``.  Every match holds the keyword literally; a text without
it isn't searched for the rule.  Priority 3 is a licence identifier or a sentence of the
licence itself, 2 a name with its version or address, 1 a bare name or hint.
The order of the lines breaks ties.  ``LIC`` stands for ``licen[sc]es?``,
``VER`` for ``(?:version |v )?``.
"""

from __future__ import annotations

# Stands in every text in which a rule matches, at the start of a word; texts
# without it are skipped.
GATE = (r" (?:a(?:pache|gpl|dvertising materials)|b(?:sd|eer ?ware)|c(?:opyright|opyleft|ommons|reative ?commons|c |c0|ddl|onfidential)"
        r"|eupl|f(?:reebsd|or good not evil)|g(?:pl|nu |cc runtime library)|l(?:icen|gpl)|m(?:ozilla|it x11|erchantab)|neither the name"
        r"|o(?:dbl|penssl project)|p(?:ermission|ublic domain|roprietary)|re(?:distribut|served)|spdx|trademark|unlicen|w(?:arrant|tfpl)|0bsd)")

REACH = 400                  # characters of the longest match

RULES = r"""
mit ~ 1 ~ mit license ~ mit license
apache ~ 1 ~ apache license ~ apache license
gpl ~ 1 ~ general public license ~ general public license

mit ~ 3 ~ spdx ~ spdx license identifier mit
mit-0 ~ 3 ~ spdx ~ spdx license identifier mit 0
apache-2.0 ~ 3 ~ spdx ~ spdx license identifier apache 2 0
gpl-2.0-only ~ 3 ~ spdx ~ spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later ~ 3 ~ spdx ~ spdx license identifier gpl 2 0 or later
gpl-3.0-only ~ 3 ~ spdx ~ spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later ~ 3 ~ spdx ~ spdx license identifier gpl 3 0 or later
lgpl-2.1 ~ 3 ~ spdx ~ spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 ~ 3 ~ spdx ~ spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 ~ 3 ~ spdx ~ spdx license identifier agpl 3 0(?: only| or later)?
bsd-2-clause ~ 3 ~ spdx ~ spdx license identifier bsd 2 clause
bsd-3-clause ~ 3 ~ spdx ~ spdx license identifier bsd 3 clause
mpl-2.0 ~ 3 ~ spdx ~ spdx license identifier mpl 2 0
epl-2.0 ~ 3 ~ spdx ~ spdx license identifier epl 2 0
isc ~ 3 ~ spdx ~ spdx license identifier isc
unlicense ~ 3 ~ spdx ~ spdx license identifier unlicense
cc0-1.0 ~ 3 ~ spdx ~ spdx license identifier cc0 1 0
cc-by-4.0 ~ 3 ~ spdx ~ spdx license identifier cc by 4 0
cc-by-sa-4.0 ~ 3 ~ spdx ~ spdx license identifier cc by sa 4 0
zlib ~ 3 ~ spdx ~ spdx license identifier zlib
bsl-1.0 ~ 3 ~ spdx ~ spdx license identifier bsl 1 0
spdx ~ 1 ~ spdx license identifier ~ spdx license identifier \S{1,40}

mit ~ 3 ~ permission is hereby granted free of charge ~ permission is hereby granted free of charge to any person obtaining a copy of this software
mit ~ 3 ~ permission ~ the above copyright notice and this permission notice shall be included in all copies or substantial portions
mit ~ 2 ~ licen ~ (?:released|licensed|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?mit LIC
mit ~ 2 ~ licen ~ opensource org LIC mit
mit ~ 2 ~ licen ~ LIC mit
mit ~ 1 ~ licen ~ (?:the )?mit (?:(?:style|type|like) )?LIC
mit ~ 1 ~ mit x11 ~ mit x11
mit ~ 1 ~ licensed ~ mit licensed
x11 ~ 2 ~ licen ~ x11 LIC
isc ~ 3 ~ permission to use copy modify and ~ permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
isc ~ 2 ~ licen ~ (?:the )?isc LIC
mit-0 ~ 2 ~ licen ~ mit no attribution LIC
hpnd ~ 3 ~ permission to use ~ permission to use copy modify (?:and )?distribute and sell this software and its documentation
hpnd ~ 2 ~ permission notice ~ historical permission notice and disclaimer
ntp ~ 3 ~ permission to use ~ permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted

apache-2.0 ~ 3 ~ apache license ~ licensed under the apache license version 2 0(?: the license)?
apache-2.0 ~ 3 ~ you may not use this file except in compliance with the license ~ you may not use this file except in compliance with the license
apache-2.0 ~ 2 ~ apache ~ apache (?:software )?LIC (?:version |v )?2(?: 0)?
apache-2.0 ~ 2 ~ apache ~ apache org LIC LIC 2 0
apache-2.0 ~ 2 ~ apache ~ apache 2 0
apache-2.0 ~ 2 ~ apache ~ apache2 LIC
apache-1.1 ~ 2 ~ apache ~ apache (?:software )?LIC VER1 1
apache-1.0 ~ 2 ~ apache ~ apache (?:software )?LIC VER1 0
apache ~ 1 ~ apache ~ (?:the )?apache (?:software )?(?:foundation )?LIC
apache ~ 1 ~ apache licensed ~ apache licensed
apache-2.0 ~ 3 ~ patent ~ grant of patent license subject to the terms and conditions of this license
apache-2.0 ~ 3 ~ copyright license ~ grant of copyright license subject to the terms and conditions of this license

gpl-3.0 ~ 3 ~ general public license ~ licensed under the gnu general public license version 3
gpl-2.0 ~ 3 ~ general public license ~ licensed under the gnu general public license version 2
gpl-2.0-or-later ~ 3 ~ general public license ~ gnu general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version
gpl-3.0-or-later ~ 3 ~ general public license ~ gnu general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version
gpl-2.0-only ~ 3 ~ general public license ~ gnu general public license version 2 as published by the free software foundation
gpl-3.0-only ~ 3 ~ general public license ~ gnu general public license version 3 as published by the free software foundation
gpl-1.0 ~ 2 ~ gpl ~ gpl ?v?1(?: 0)?
gpl-2.0 ~ 2 ~ gpl ~ (?:gnu )?gpl(?: version)? ?v?2(?: 0)?
gpl-3.0 ~ 2 ~ gpl ~ (?:gnu )?gpl(?: version)? ?v?3(?: 0)?
gpl-2.0-or-later ~ 2 ~ gpl ~ gpl(?: version)? ?v?2(?: 0)? or later
gpl-3.0-or-later ~ 2 ~ gpl ~ gpl(?: version)? ?v?3(?: 0)? or later
gpl-1.0 ~ 2 ~ general public licen ~ general public LIC VER1(?: 0)?
gpl-2.0 ~ 2 ~ general public licen ~ general public LIC VER2(?: 0)?
gpl-3.0 ~ 2 ~ general public licen ~ general public LIC VER3(?: 0)?
gpl-2.0 ~ 2 ~ gnu org ~ gnu org LIC(?: old LIC)? gpl 2 0
gpl-3.0 ~ 2 ~ gnu org ~ gnu org LIC gpl 3 0
gpl ~ 2 ~ gnu org ~ gnu org (?:copyleft|LIC) gpl
gpl ~ 1 ~ gnu ~ gnu gpl
gpl ~ 1 ~ gnu ~ gnu general public LIC
gpl ~ 1 ~ gpl ~ gpl LIC
gpl ~ 1 ~ gpl ~ under (?:the )?(?:terms of the )?gpl
gpl ~ 3 ~ without any warranty ~ but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose
gpl ~ 3 ~ redistribut ~ this (?:program|library|file|software) is free software you can redistribute it and or modify it
gpl ~ 2 ~ gnu general public licen ~ you should have received a copy of the gnu general public LIC
gpl-classpath ~ 2 ~ gpl ~ gpl (?:v?2 |2 0 )?with (?:the )?classpath exception
gpl-classpath ~ 2 ~ gnu ~ gnu general public LIC (?:version 2 )?with (?:the )?classpath exception
gcc-exception ~ 2 ~ gcc runtime library exception ~ gcc runtime library exception
copyleft ~ 1 ~ copyleft ~ copyleft(?: LIC)?
lgpl-2.0 ~ 2 ~ library general public licen ~ (?:gnu )?library general public LIC(?: version 2(?: 0)?)?
lgpl-2.1 ~ 2 ~ lesser general public licen ~ lesser general public LIC VER2 1
lgpl-3.0 ~ 2 ~ lesser general public licen ~ lesser general public LIC VER3(?: 0)?
lgpl ~ 2 ~ lesser general public licen ~ (?:gnu )?lesser general public LIC
lgpl-2.1 ~ 2 ~ lgpl ~ lgpl(?: version)? ?v?2 1
lgpl-3.0 ~ 2 ~ lgpl ~ lgpl(?: version)? ?v?3(?: 0)?
lgpl ~ 1 ~ lgpl ~ (?:gnu )?lgpl
agpl-3.0 ~ 2 ~ affero general public licen ~ affero general public LIC VER3(?: 0)?
agpl ~ 2 ~ affero general public licen ~ (?:gnu )?affero general public LIC
agpl-3.0 ~ 2 ~ agpl ~ agpl(?: version)? ?v?3(?: 0)?
agpl ~ 1 ~ agpl ~ (?:gnu )?agpl
gfdl-1.3 ~ 2 ~ free documentation licen ~ free documentation LIC VER1 3
gfdl-1.2 ~ 2 ~ free documentation licen ~ free documentation LIC VER1 2
gfdl ~ 2 ~ free documentation licen ~ (?:gnu )?free documentation LIC
gfdl ~ 3 ~ permission is granted to copy ~ permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation LIC
gfdl ~ 1 ~ gnu f ~ gnu fdl

bsd-3-clause ~ 3 ~ neither the name ~ neither the name of (?:\S{1,20} ){1,12}nor the names of its contributors may be used to endorse or promote products
bsd-2-clause ~ 3 ~ redistribut ~ redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd ~ 3 ~ redistributions of source code must retain ~ redistributions of source code must retain the above copyright notice this list of conditions
bsd ~ 3 ~ redistributions in binary form must reproduce ~ redistributions in binary form must reproduce the above copyright notice this list of conditions
bsd-4-clause ~ 3 ~ advertising materials ~ all advertising materials mentioning features or use of this software must display the following acknowledgement
bsd ~ 3 ~ warrant ~ provided by the (?:\S{1,20} ){1,8}as is and any express or implied warranties
bsd-2-clause ~ 2 ~ bsd ~ (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: LIC)?
bsd-3-clause ~ 2 ~ bsd ~ (?:bsd 3 clause|3 clause bsd|(?:new|modified|revised) bsd)(?: LIC)?
bsd-4-clause ~ 2 ~ bsd ~ (?:bsd 4 clause|4 clause bsd|(?:original|old) bsd)(?: LIC)?
0bsd ~ 2 ~ bsd ~ (?:0bsd|zero clause bsd|bsd zero clause)(?: LIC)?
bsd-1-clause ~ 2 ~ bsd ~ (?:bsd 1 clause|1 clause bsd)(?: LIC)?
bsd-patent ~ 2 ~ bsd ~ bsd (?:2 clause )?plus patent(?: LIC)?
bsd ~ 1 ~ bsd ~ bsd (?:style |type |like )?LIC
bsd ~ 1 ~ bsd ~ bsd licensed
bsd ~ 2 ~ licen ~ opensource org LIC bsd(?: \S{1,20} clause| license)?
bsd ~ 1 ~ licen ~ berkeley software distribution LIC

mpl-1.0 ~ 2 ~ mozilla public licen ~ mozilla public LIC VER1 0
mpl-1.1 ~ 2 ~ mozilla public licen ~ mozilla public LIC VER1 1
mpl-2.0 ~ 2 ~ mozilla public licen ~ mozilla public LIC VER2(?: 0)?
mpl-2.0 ~ 3 ~ mozilla public licen ~ this source code form is subject to the terms of the mozilla public LIC v 2 0
mpl-2.0 ~ 2 ~ mozilla ~ mozilla org mpl 2 0
mpl ~ 1 ~ mozilla ~ mozilla public LIC
mpl ~ 1 ~ mozilla ~ mozilla org mpl
npl ~ 2 ~ licen ~ netscape public LIC(?: version 1 [01])?
epl-1.0 ~ 2 ~ licen ~ eclipse public LIC VER1 0
epl-2.0 ~ 2 ~ licen ~ eclipse public LIC VER2 0
epl ~ 1 ~ licen ~ eclipse public LIC
edl-1.0 ~ 2 ~ licen ~ eclipse distribution LIC(?: VER1 0)?
cpl-1.0 ~ 2 ~ licen ~ common public LIC(?: VER1 0)?
ipl-1.0 ~ 2 ~ licen ~ ibm public LIC(?: VER1 0)?
cddl-1.0 ~ 2 ~ common development and distribution licen ~ common development and distribution LIC(?: VER1 0)?
cddl-1.1 ~ 2 ~ common development and distribution licen ~ common development and distribution LIC VER1 1
cddl ~ 1 ~ cddl ~ cddl(?: 1 [01])?
cpal-1.0 ~ 2 ~ licen ~ common public attribution LIC(?: VER1 0)?
eupl-1.1 ~ 2 ~ eupl ~ eupl(?: VER| v)?1 1
eupl-1.2 ~ 2 ~ eupl ~ eupl(?: VER| v)?1 2
eupl ~ 2 ~ european union public licen ~ european union public LIC
eupl ~ 1 ~ eupl ~ eupl
cecill ~ 2 ~ licen ~ cecill(?: [abc])?(?: free software)? LIC(?: agreement)?
cecill ~ 2 ~ licen ~ licence cecill
osl-3.0 ~ 2 ~ licen ~ open software LIC VER3 0
osl ~ 1 ~ licen ~ open software LIC
afl-3.0 ~ 2 ~ licen ~ academic free LIC VER3 0
afl-2.1 ~ 2 ~ licen ~ academic free LIC VER2 1
afl ~ 1 ~ licen ~ academic free LIC
ecl-2.0 ~ 2 ~ licen ~ educational community LIC(?: VER2 0)?
artistic-1.0 ~ 2 ~ licen ~ artistic LIC VER1 0
artistic-2.0 ~ 2 ~ licen ~ artistic LIC VER2 0
artistic ~ 1 ~ licen ~ (?:the )?(?:perl )?artistic LIC
perl ~ 2 ~ redistribut ~ (?:you can )?redistribute it and or modify it under the same terms as perl itself
bsl-1.0 ~ 2 ~ licen ~ boost software LIC(?: VER1 0)?
bsl-1.0 ~ 2 ~ licen ~ boost org LIC 1 0
zlib ~ 2 ~ licen ~ zlib(?: libpng)? LIC
zlib ~ 3 ~ permission is granted to anyone to use this software ~ permission is granted to anyone to use this software for any purpose including commercial applications
zlib ~ 3 ~ warrant ~ this software is provided as is without any express or implied warranty in no event will the authors be held liable
libpng ~ 2 ~ licen ~ (?:png reference library|libpng) LIC(?: version 2)?
unlicense ~ 3 ~ public domain ~ this is free and unencumbered software released into the public domain
unlicense ~ 2 ~ licen ~ (?:the )?unlicense
unlicense ~ 2 ~ licen ~ unlicense org
wtfpl ~ 2 ~ licen ~ do what the (?:fuck|f) you want to public LIC
wtfpl ~ 1 ~ wtfpl ~ wtfpl
beerware ~ 2 ~ licen ~ beer ?ware LIC
json ~ 3 ~ for good not evil ~ the software shall be used for good not evil
json ~ 1 ~ licen ~ json LIC
vim ~ 2 ~ licen ~ vim LIC
tcl ~ 2 ~ licen ~ tcl(?: tk)? LIC
php-3.01 ~ 2 ~ licen ~ php LIC VER3 01
php ~ 1 ~ licen ~ php LIC
python-2.0 ~ 2 ~ licen ~ python software foundation LIC(?: VER2(?: 0)?)?
psf ~ 1 ~ licen ~ (?:psf|python) LIC
ruby ~ 1 ~ licen ~ ruby(?: s)? LIC
openssl ~ 2 ~ licen ~ openssl(?: ssleay)? LIC
openssl ~ 3 ~ openssl project ~ this product includes software developed by the openssl project
sleepycat ~ 2 ~ licen ~ sleepycat(?: software)? LIC
postgresql ~ 2 ~ licen ~ postgresql LIC
ncsa ~ 2 ~ licen ~ university of illinois(?: ncsa)?(?: open source)? LIC
ncsa ~ 2 ~ licen ~ ncsa(?: open source)? LIC
llvm-exception ~ 2 ~ apache ~ apache (?:LIC )?(?:VER)?2 0 with llvm exceptions?
zpl-2.1 ~ 2 ~ licen ~ zope public LIC(?: VER2 [01])?
qpl-1.0 ~ 2 ~ licen ~ q public LIC(?: VER1 0)?
w3c ~ 2 ~ licen ~ w3c software(?: notice)? (?:and )?(?:document )?LIC
unicode ~ 2 ~ licen ~ unicode(?: inc)? LIC(?: agreement)?(?: data files and software)?
ofl-1.1 ~ 2 ~ licen ~ sil open font LIC(?: VER1 1)?
ofl ~ 1 ~ licen ~ open font LIC
ubuntu-font ~ 2 ~ licen ~ ubuntu font LIC(?: VER1 0)?
lppl ~ 2 ~ licen ~ latex project public LIC(?: VER1 3[abc]?)?
ms-pl ~ 2 ~ licen ~ microsoft public LIC
ms-rl ~ 2 ~ licen ~ microsoft reciprocal LIC
apsl-2.0 ~ 2 ~ licen ~ apple public source LIC(?: VER2 0)?
mulan-2.0 ~ 2 ~ licen ~ mulan (?:psl|permissive software) LIC(?: VER2(?: 0)?)?
upl-1.0 ~ 2 ~ licen ~ universal permissive LIC(?: VER1 0)?
blueoak-1.0 ~ 2 ~ licen ~ blue oak model LIC(?: 1 0 0)?
curl ~ 2 ~ licen ~ curl LIC
info-zip ~ 2 ~ licen ~ info zip LIC
bzip2 ~ 2 ~ licen ~ bzip2 LIC
ijg ~ 2 ~ licen ~ independent jpeg group LIC
fair ~ 2 ~ licen ~ (?:the )?fair LIC
imagemagick ~ 2 ~ licen ~ imagemagick LIC

cc0-1.0 ~ 2 ~ cc0 ~ cc0(?: 1 0)?(?: universal)?
cc0-1.0 ~ 2 ~ commons ~ creative commons zero(?: v1 0 universal)?
cc0-1.0 ~ 2 ~ commons ~ creativecommons org publicdomain zero 1 0
cc-by-nc-nd-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by nc nd 4 0
cc-by-nc-sa-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by nc sa 4 0
cc-by-nc-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by nc 4 0
cc-by-nd-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by nd 4 0
cc-by-sa-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by sa 4 0
cc-by-4.0 ~ 3 ~  cc  ~ licensed under (?:a )?cc by 4 0
cc-by-nc-nd ~ 2 ~  cc  ~ cc by nc nd(?: [1234] [05])?
cc-by-nc-sa ~ 2 ~  cc  ~ cc by nc sa(?: [1234] [05])?
cc-by-nc ~ 2 ~  cc  ~ cc by nc(?: [1234] [05])?
cc-by-nd ~ 2 ~  cc  ~ cc by nd(?: [1234] [05])?
cc-by-sa ~ 2 ~  cc  ~ cc by sa(?: [1234] [05])?
cc-by ~ 2 ~  cc  ~ cc by(?: [1234] [05])?
cc-by-nc-nd ~ 2 ~ commons ~ creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-nc-sa ~ 2 ~ commons ~ creative commons attribution non ?commercial share ?alike(?: [1234] [05])?
cc-by-nc ~ 2 ~ commons ~ creative commons attribution non ?commercial(?: [1234] [05])?
cc-by-nd ~ 2 ~ commons ~ creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1234] [05])?
cc-by-sa ~ 2 ~ commons ~ creative commons attribution share ?alike(?: [1234] [05])?
cc-by ~ 2 ~ commons ~ creative commons attribution(?: [1234] [05])?
cc-by-nc-nd ~ 2 ~ commons ~ creativecommons org LIC by nc nd(?: [1234] [05])?
cc-by-nc-sa ~ 2 ~ commons ~ creativecommons org LIC by nc sa(?: [1234] [05])?
cc-by-nc ~ 2 ~ commons ~ creativecommons org LIC by nc(?: [1234] [05])?
cc-by-nd ~ 2 ~ commons ~ creativecommons org LIC by nd(?: [1234] [05])?
cc-by-sa ~ 2 ~ commons ~ creativecommons org LIC by sa(?: [1234] [05])?
cc-by ~ 2 ~ commons ~ creativecommons org LIC by(?: [1234] [05])?
cc ~ 1 ~ commons ~ creative commons LIC
cc ~ 1 ~ commons ~ creative commons
cc-sampling ~ 2 ~ commons ~ creative commons sampling(?: plus)?(?: 1 0)?
pddl-1.0 ~ 2 ~ public domain ~ public domain dedication (?:and )?LIC(?: VER1 0)?
odbl-1.0 ~ 2 ~ licen ~ open (?:data commons open )?database LIC(?: VER1 0)?
odbl-1.0 ~ 1 ~ odbl ~ odbl(?: 1 0)?
odc-by-1.0 ~ 2 ~ commons ~ open data commons attribution LIC(?: VER1 0)?
ogl-3.0 ~ 2 ~ licen ~ open government LIC VER3 0
ogl ~ 1 ~ licen ~ open government LIC
cdla-permissive ~ 2 ~ licen ~ community data LIC agreement permissive(?: VER[12] 0)?
cdla-sharing ~ 2 ~ licen ~ community data LIC agreement sharing(?: VER1 0)?
public-domain ~ 2 ~ public domain ~ (?:released|placed|dedicated|put) (?:in|into|to) the public domain
public-domain ~ 1 ~ public domain ~ (?:in the )?public domain

elastic-2.0 ~ 2 ~ licen ~ elastic LIC(?: VER2 0)?
sspl-1.0 ~ 2 ~ licen ~ server side public LIC(?: VER1(?: 0)?)?
busl-1.1 ~ 2 ~ licen ~ business source LIC(?: VER1 1)?
commons-clause ~ 2 ~ commons ~ commons clause(?: LIC condition)?(?: v1 0)?
polyform-nc ~ 2 ~ licen ~ polyform noncommercial LIC(?: 1 0 0)?
polyform-sb ~ 2 ~ licen ~ polyform small business LIC(?: 1 0 0)?
confluent ~ 2 ~ licen ~ confluent community LIC(?: VER1 0)?
timescale ~ 2 ~ licen ~ timescale LIC
bigscience-openrail-m ~ 2 ~ licen ~ (?:bigscience |creativeml )?open ?rail(?: \+\+)?(?: m)? LIC
llama-community ~ 2 ~ licen ~ llama [234](?: [0-9])? community LIC(?: agreement)?
gemma ~ 2 ~ licen ~ gemma LIC
oracle-bcl ~ 2 ~ licen ~ oracle binary code LIC(?: agreement)?
oracle-fdhut ~ 2 ~ licen ~ oracle free use terms and conditions LIC
intel-simplified ~ 2 ~ licen ~ intel simplified software LIC
nvidia-eula ~ 2 ~ licen ~ nvidia (?:software|cuda)(?: \S{1,20}){0,3} LIC(?: agreement)?
eula ~ 1 ~ licen ~ end user LIC(?: agreement)?
shareware ~ 1 ~ licen ~ shareware LIC
freeware ~ 1 ~ licen ~ freeware LIC
commercial ~ 1 ~ licen ~ (?:commercial|proprietary|enterprise) LIC
dual-licensed ~ 1 ~ licen ~ dual licensed
proprietary ~ 2 ~ reserved ~ all rights reserved
proprietary ~ 2 ~ proprietary ~ proprietary and confidential
proprietary ~ 2 ~ confidential ~ confidential and proprietary
proprietary ~ 1 ~ permission ~ (?:may not be )?(?:reproduced|copied|distributed|used) without (?:the )?(?:prior |express )?(?:written )?permission
trademark ~ 1 ~ trademark ~ registered trademarks? of
no-warranty ~ 1 ~ warrant ~ (?:provided )?as is without warranty of any kind
no-warranty ~ 1 ~ merchantab ~ warranties of merchantability
copyright ~ 1 ~ copyright ~ copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
copyright ~ 1 ~ copyright ~ copyright holders?
see-license ~ 1 ~ licen ~ see (?:the )?(?:file )?LIC(?: file| txt| md)?(?: for (?:details|more information))?
unspecified ~ 1 ~ licens ~ (?:is |are )?licensed under (?:the )?(?:terms of the )?
"""


def rules() -> list:
    """(order, label, priority, keyword, regex) of every line."""
    out = []
    for line in RULES.splitlines():
        if line.strip():
            label, priority, keyword, regex = line.split(" ~ ")
            regex = regex.strip().replace("LIC", "licen[sc]es?").replace("VER", "(?:version |v )?")
            out.append((len(out), label, int(priority), keyword, regex))
    return out
