"""Hand-written license signatures: title, header, notice and clause wording.

Fixed values: the wording is that of the public license texts, as normalised
words (A-Z lowered, runs of other ASCII characters one space). Each line is
label, keyword (a rarer word that every match holds), kind and regex. The order
is that of the table; the kind gives priority and confidence.
"""

from __future__ import annotations

# kind: priority (lower wins), confidence.
KINDS = {"header": (2, 0.95), "title": (3, 0.9), "notice": (3, 0.85), "clause": (4, 0.7), "mention": (5, 0.6)}

SIGNATURES = """
mit | mit | title | the mit license mit
mit | expat | title | expat license
mit | mit | header | licensed under the mit license
mit | hereby | header | hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | sublicense | clause | to use copy modify merge publish distribute sublicense and or sell copies of the software
mit | substantial | clause | copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit | noninfringement | clause | without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement
mit | holders | clause | in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit-0 | mit | title | mit no attribution(?: license)? copyright
mit-0 | attribution | header | licensed under the mit no attribution license
mit-0 | hereby | clause | permission is hereby granted free of charge .{0,200}to permit persons to whom the software is furnished to do so the software is provided
apache | apache | title | apache license version 2 0 january 2004
apache | apache | title | apache software license version 1 [01]
apache | apache | header | licensed under the apache license version 2 0 the license
apache | compliance | header | you may not use this file except in compliance with the license you may obtain a copy of the license at
apache | apache | notice | https? www apache org licenses license 2 0
apache | basis | clause | distributed under the license is distributed on an as is basis without warranties or conditions of any kind
apache | permissions | clause | see the license for the specific language governing permissions and limitations under the license
apache | asf | header | licensed to the apache software foundation asf under one or more contributor license agreements
apache | notice | clause | see the notice file distributed with this work for additional information regarding copyright ownership
apache | contributor | clause | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache | patent | clause | no charge royalty free irrevocable except as stated in this section patent license
apache | apache | clause | this product includes software developed by the apache (?:software foundation|group).{0,80}copyright
gpl | gnu | title | gnu general public license version [123](?: june 1991| 29 june 2007| february 1989)?
gpl | gnu | header | under the terms of the gnu general public license as published by the free software foundation
gpl | gnu | notice | you should have received a copy of the gnu general public license along with this program
gpl | gnu | notice | see the gnu general public license for more details
gpl | gpl | notice | released under the (?:gnu )?gpl license
gpl | gpl | mention | gpl (?:v|version )?[23](?: 0)?(?: or later| only)? license
gpl | copyleft | clause | copyleft license for software and other kinds of works
gpl | everyone | clause | everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed
gpl | warranty | clause | this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability .{0,60}general public license
gpl | boston | clause | free software foundation inc (?:59 temple place|51 franklin)(?: street| st)? .{0,40}boston
gpl | gnu | notice | https? www gnu org licenses gpl
gpl-classpath | exception | notice | as a special exception the copyright holders of this library give you permission to link this library with independent modules
gpl-classpath | classpath | mention | classpath exception .{0,60}license
gpl-gcc | gcc | notice | gcc runtime library exception .{0,80}license
gpl-font | font | notice | as a special exception if you create a document which uses this font .{0,200}license
lgpl | lesser | title | gnu lesser general public license version (?:2 1|3)(?: february 1999| 29 june 2007)?
lgpl | library | title | gnu library general public license version 2
lgpl | lesser | header | under the terms of the gnu lesser general public license as published by the free software foundation
lgpl | library | header | under the terms of the gnu library general public license as published by the free software foundation
lgpl | lesser | notice | you should have received a copy of the gnu lesser general public license along with this (?:library|program)
lgpl | lesser | notice | see the gnu lesser general public license for more details
lgpl | lesser | clause | this license the lesser general public license applies to some specially designated software (?:packages )?typically libraries
lgpl | relink | clause | modify the work and then relink to produce a modified .{0,60}license
lgpl | lgpl | mention | lgpl (?:v|version )?(?:2 1|2|3)(?: or later| only)? license
lgpl | gnu | notice | https? www gnu org licenses lgpl
agpl | affero | title | gnu affero general public license version 3(?: 19 november 2007)?
agpl | affero | title | affero general public license version 1
agpl | affero | header | under the terms of the gnu affero general public license as published by the free software foundation
agpl | affero | notice | you should have received a copy of the gnu affero general public license along with this program
agpl | affero | notice | see the gnu affero general public license for more details
agpl | remotely | clause | all users interacting with it remotely through a computer network .{0,200}license
agpl | agpl | mention | agpl (?:v|version )?3(?: 0)?(?: or later| only)? license
agpl | gnu | notice | https? www gnu org licenses agpl
gfdl | documentation | title | gnu free documentation license version 1 [123]
gfdl | documentation | header | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | invariant | clause | with no invariant sections no front cover texts and no back cover texts a copy of the license is included
bsd | redistributions | clause | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions | clause | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd-3-clause | neither | clause | neither the name of .{1,80} nor the names of its contributors may be used to endorse or promote products derived from this software .{0,120}copyright
bsd-3-clause | bsd | title | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd) licen[sc]e
bsd-2-clause | bsd | title | (?:bsd 2 clause|2 clause bsd|simplified bsd) licen[sc]e
bsd-2-clause | freebsd | title | freebsd licen[sc]e
bsd-2-clause | freebsd | title | the freebsd copyright
bsd-4-clause | advertising | clause | all advertising materials mentioning features or use of this software must display the following acknowledgement .{0,200}copyright
bsd-4-clause | bsd | title | (?:bsd 4 clause|4 clause bsd|original bsd|old bsd) licen[sc]e
bsd | bsd | header | use of this source code is governed by a bsd style license that can be found in the license file
bsd | bsd | header | (?:licensed|released|distributed) under (?:the |a )?(?:terms of the )?(?:new |modified |simplified )?bsd(?: style)? licen[sc]e
bsd | regents | notice | copyright (?:c )?.{0,30}the regents of the university of california
bsd | contributors | clause | provided by the copyright holders and contributors as is and any express or implied warranties
bsd | consequential | clause | in no event shall the copyright (?:holder|owner|holders) or contributors be liable for any direct indirect incidental special exemplary or consequential damages
bsd-0 | bsd | title | (?:zero clause bsd|bsd zero clause|0 clause bsd) licen[sc]e
bsd-0 | 0bsd | title | 0bsd licen[sc]e
bsd-0 | permission | clause | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided
bsd-protection | protection | title | bsd protection license
isc | isc | title | isc license(?: isc)? copyright
isc | isc | header | (?:licensed|released) under the isc license
isc | consortium | notice | copyright (?:c )?.{0,30}internet (?:systems|software) consortium
isc | disclaims | clause | the author disclaims all warranties with regard to this software .{0,300}copyright
isc | permission | clause | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice
mpl | mozilla | title | mozilla public license version (?:1 0|1 1|2 0)
mpl | mozilla | header | this source code form is subject to the terms of the mozilla public license v 2 0
mpl | mpl | notice | if a copy of the mpl was not distributed with this file you can obtain one at .{0,60}license
mpl | mozilla | notice | https? (?:www )?mozilla org mpl .{0,60}license
mpl | mozilla | header | the contents of this file are subject to the mozilla public license version 1 [01]
mpl | incompatible | clause | incompatible with secondary licenses as defined by the mozilla public license
mpl | rights | clause | for the specific language governing rights and limitations under the license
mpl | initial | notice | the initial developer of the original code is .{0,200}(?:license|copyright)
mpl | alternatively | clause | alternatively the contents of this file may be used under the terms of either the gnu general public license
npl | netscape | title | netscape public license version 1 [01]
npl | netscape | header | the contents of this file are subject to the netscape public license
epl | eclipse | title | eclipse public license v(?:ersion)? ?[12] 0
epl | eclipse | header | made available under the terms of the eclipse public license
epl | eclipse | notice | https? www eclipse org (?:legal|org documents) epl .{0,40}(?:license|copyright)
epl | accompanying | clause | this program and the accompanying materials are made available under the terms of the eclipse public license
epl | eclipse | title | eclipse distribution license v(?:ersion)? ?1 0
epl | recipient | clause | any use reproduction or distribution of the program constitutes recipient s acceptance of this agreement .{0,200}license
cpl | common | title | common public license version (?:0 5|1 0)
cpl | common | header | made available under the terms of the common public license
ipl | ibm | title | ibm public license version 1 0
cddl | development | title | common development and distribution license (?:cddl )?version 1 [01]
cddl | development | header | the contents of this file are subject to the terms of the common development and distribution license
cddl | cddl | notice | cddl header start .{0,300}license
cddl | opensolaris | notice | usr src opensolaris license
cddl | brackets | clause | if applicable add the following below this cddl header with the fields enclosed by brackets .{0,120}(?:copyright|license)
sissl | industry | title | sun industry standards source license version 1 [12]
spl | sun | title | sun public license version 1 0
apsl | apple | title | apple public source license version (?:1 [012]|2 0)
apsl | apple | header | this file contains original code and or modifications of original code as defined in and that are subject to the apple public source license
zlib | zlib | title | zlib(?: libpng)? license
zlib | misrepresented | clause | the origin of this software must not be misrepresented you must not claim that you wrote the original software .{0,400}(?:copyright|redistribut[a-z]*)
zlib | altered | clause | altered source versions must be plainly marked as such .{0,200}(?:redistribut|license)[a-z]*
zlib | redistribute | clause | to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely
zlib | altered | clause | this notice may not be removed or altered from any source (?:re)?distribution .{0,200}(?:copyright|license)
libpng | png | title | png reference library license(?: version 2)?
libpng | libpng | notice | this copy of the libpng notices is provided for your convenience .{0,200}(?:copyright|license)
boost | boost | title | boost software license version 1 0(?: august 17th 2003)?
boost | boost | header | distributed under the boost software license version 1 0
boost | boost | notice | https? www boost org license 1 0 txt
boost | machine | clause | unless such copies or derivative works are solely in the form of machine executable object code .{0,200}(?:license|copyright)
boost | license | notice | see accompanying file license 1 0 txt
artistic | artistic | title | the artistic license(?: 2 0| 1 0)?
artistic | artistic | title | artistic license 2 0 copyright
artistic | artistic | header | under the (?:terms of the )?(?:clarified |perl )?artistic license
artistic | perl | header | (?:free software|library) you can redistribute it and or modify it under the same terms as perl(?: itself)?
artistic | package | clause | you may make and give away verbatim copies of the source form of the standard version of this package .{0,200}copyright
unlicense | unencumbered | header | this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute
unlicense | unlicense | notice | https? unlicense org
unlicense | relinquishment | clause | overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law
unlicense | heirs | clause | we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors .{0,200}copyright
wtfpl | fuck | title | do what the fuck you want to public license(?: version 2)?
wtfpl | fuck | clause | you just do what the fuck you want to .{0,120}licen[sc]e
wtfpl | wtfpl | header | (?:licensed|released) under the wtfpl license
beerware | beer | title | the beer ware license(?: revision 42)?
beerware | beer | clause | if we meet some day and you think this stuff is worth it you can buy me a beer in return .{0,200}licen[sc]e
cc0 | cc0 | title | cc0 1 0 universal (?:license|public domain dedication)
cc0 | creative | title | creative commons (?:legal code )?cc0 1 0 universal .{0,60}licen[sc]e
cc0 | waived | header | to the extent possible under law .{1,80} has waived all copyright and related or neighboring rights
cc0 | affirmer | clause | affirmer hereby overtly fully permanently irrevocably and unconditionally waives .{0,200}copyright
cc0 | publicdomain | notice | creativecommons org publicdomain zero 1 0 .{0,60}(?:license|copyright)
cc-by | creative | title | creative commons attribution [1234] [05](?: international| unported| generic)?(?: public)? license
cc-by | creative | header | licensed under a creative commons attribution [1234] [05](?: international| unported)? license
cc-by | creativecommons | notice | creativecommons org licenses by [1234] [05]
cc-by-sa | sharealike | title | creative commons attribution sharealike [1234] [05](?: international| unported| generic)?(?: public)? license
cc-by-sa | creative | header | available under the creative commons attribution share ?alike license
cc-by-sa | creativecommons | notice | creativecommons org licenses by sa [1234] [05]
cc-by-nc | noncommercial | title | creative commons attribution noncommercial [1234] [05](?: international| unported)?(?: public)? license
cc-by-nc | creativecommons | notice | creativecommons org licenses by nc [1234] [05]
cc-by-nc-sa | creativecommons | notice | creativecommons org licenses by nc sa [1234] [05]
cc-by-nc-sa | sharealike | title | creative commons attribution noncommercial sharealike [1234] [05](?: international| unported)?(?: public)? license
cc-by-nc-nd | creativecommons | notice | creativecommons org licenses by nc nd [1234] [05]
cc-by-nc-nd | noderivatives | title | creative commons attribution noncommercial noderivatives [1234] [05](?: international| unported)?(?: public)? license
cc-by-nd | creativecommons | notice | creativecommons org licenses by nd [1234] [05]
cc-by-nd | noderivatives | title | creative commons attribution noderivatives [1234] [05](?: international| unported)?(?: public)? license
cc-sampling | sampling | title | creative commons sampling plus 1 0 .{0,20}license
odbl | database | title | open data commons open database license(?: odbl)?(?: v1 0)?
odbl | opendatacommons | notice | opendatacommons org licenses odbl
odbl | database | header | this .{1,60}is made available under the open database license
odc-by | opendatacommons | notice | opendatacommons org licenses by
odc-by | commons | title | open data commons attribution license(?: v1 0)?
pddl | dedication | title | open data commons public domain dedication and license(?: pddl)?
pddl | opendatacommons | notice | opendatacommons org licenses pddl
cdla | community | title | community data license agreement (?:permissive|sharing) version [12] 0
ogl | government | title | open government licence(?: v[123] 0)?(?: for public sector information)?
ogl | licence | header | contains public sector information licensed under the open government licence
ofl | sil | title | sil open font license version 1 [01]
ofl | font | header | this font software is licensed under the sil open font license
ofl | reserved | clause | with reserved font name .{0,120}(?:license|copyright)
ofl | scripts | notice | scripts sil org ofl .{0,60}(?:license|copyright)
ufl | ubuntu | title | ubuntu font licence version 1 0
bitstream | vera | notice | bitstream vera is a trademark of bitstream inc .{0,200}(?:copyright|license)
psf | python | title | python software foundation license version 2
psf | psf | header | psf license agreement for python [23]
psf | psf | clause | this license agreement is between the python software foundation psf
psf | beopen | title | beopen python open source license agreement version 1
psf | cnri | title | cnri (?:open source )?license agreement for python
python-cwi | stichting | notice | copyright (?:c )?.{0,40}stichting mathematisch centrum amsterdam
php | php | title | the php license version 3 0[01]?
php | php | header | this source file is subject to version (?:2 02|3 0|3 01) of the php license
php | php | clause | this product includes php software freely available from .{0,60}(?:license|copyright|redistribut[a-z]*)
zend | zend | title | zend (?:engine )?license version 2 0
ruby | ruby | header | (?:licensed|distributed|released) under the (?:same )?(?:terms (?:as|of) )?ruby (?:s )?license
ruby | ruby | title | ruby license copyright
ruby | matsumoto | notice | ruby is copyrighted free software by yukihiro matsumoto
postgresql | postgresql | title | the postgresql licen[sc]e
postgresql | postgresql | notice | portions copyright (?:c )?.{0,30}the postgresql global development group
openssl | openssl | title | openssl license copyright
openssl | openssl | clause | this product includes software developed by the openssl project for use in the openssl toolkit .{0,200}(?:license|copyright|redistribut[a-z]*)
openssl | openssl | notice | licensed under the openssl license the license you may not use this file
ssleay | eric | clause | this product includes cryptographic software written by eric young .{0,200}(?:license|copyright|redistribut[a-z]*)
ssleay | ssleay | title | original ssleay license
x11 | x11 | title | (?:the )?(?:mit )?x11 license
x11 | consortium | notice | copyright (?:c )?.{0,20}x consortium
x11 | consortium | clause | the name of the x consortium shall not be used in advertising .{0,200}(?:copyright|license)
xfree86 | xfree86 | title | xfree86 (?:project )?license(?: version 1 1)?
ncsa | ncsa | title | university of illinois ncsa open source license
ncsa | ncsa | header | (?:licensed|distributed) under the university of illinois open source license .{0,20}ncsa
ncsa | illinois | header | this file is distributed under the university of illinois open source license
llvm | llvm | title | apache license v2 0 with llvm exceptions
llvm | llvm | header | part of the llvm project under the apache license v2 0 with llvm exceptions
ms-pl | microsoft | title | microsoft public license(?: ms pl)?
ms-rl | microsoft | title | microsoft reciprocal license(?: ms rl)?
ms-lpl | microsoft | title | microsoft limited public license
ms-eula | microsoft | notice | microsoft software license terms
osl | open | title | open software license(?: osl)? v(?:ersion)? ?[123] [01]
osl | licensed | header | licensed under the open software license version [123] [01]
afl | academic | title | academic free license(?: afl)? v(?:ersion)? ?[123] [012]
afl | academic | header | licensed under the academic free license version [123] [012]
ecl | educational | title | educational community license version [12] 0
ecl | educational | header | licensed under the educational community license version 2 0
qpl | q | title | the q public license version 1 0
qpl | q | header | may be distributed under the terms of the q public license
w3c | w3c | title | w3c (?:software notice and license|software and document license|document license)
w3c | consortium | notice | copyright (?:c )?.{0,40}world wide web consortium
lppl | latex | title | latex project public license(?: lppl)?(?: version)? 1 [0123]
lppl | latex | header | may be distributed and or modified under the conditions of the latex project public license
lppl | lppl | notice | this work has the lppl maintenance status .{0,60}license
cecill | cecill | title | cecill (?:b |c )?free software license agreement
cecill | cecill | header | governed by the cecill (?:b |c )?license under french law
upl | universal | title | the universal permissive license(?: upl)? version 1 0
eupl | european | title | european union public licen[sc]e(?: v ?1 [012])?
eupl | eupl | header | licensed under the eupl version 1 [12] .{0,60}licen[sc]e
bsl | business | title | business source license 1 1
bsl | licensor | clause | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
sspl | server | title | server side public license(?: version 1)?
elastic | elastic | title | elastic license(?: 2 0| version 2 0)?
elastic | elastic | header | licensed under the elastic license
commons-clause | clause | title | commons clause license condition v1 0
confluent | confluent | title | confluent community license(?: agreement)?(?: version 1 0)?
timescale | timescale | title | timescale license agreement
polyform | polyform | title | polyform (?:noncommercial|small business|strict|shield|perimeter) license 1 0 0
prosperity | prosperity | title | the prosperity public license [23] 0 0
parity | parity | title | the parity public license [67] 0 0
blueoak | oak | title | blue oak model license 1 0 0
vim | vim | title | vim license
jpeg | jpeg | notice | this software is based in part on the work of the independent jpeg group .{0,200}(?:copyright|license)
curl | stenberg | title | copyright and permission notice copyright (?:c )?.{0,30}daniel stenberg
sqlite | blessing | notice | the author disclaims copyright to this source code in place of a legal notice here is a blessing
json | evil | clause | the software shall be used for good not evil .{0,200}(?:license|copyright)
sleepycat | sleepycat | title | the sleepycat license
icu | icu | title | icu license icu 1 8 1 and later
unicode | unicode | title | unicode(?: inc)? license agreement data files and software
info-zip | zip | title | this is version .{1,40} of the info zip (?:copyright and )?license
ftl | freetype | title | the freetype project license
ftl | freetype | notice | portions of this software are copyright (?:c )?.{0,30}the freetype project
ijg | lane | notice | this software is copyright c .{0,30}thomas g lane
tcl | scriptics | notice | copyrighted by the regents of the university of california sun microsystems inc scriptics corporation
vsl | vovida | title | the vovida software license v(?:ersion)? 1 0
zpl | zope | title | zope public license(?: zpl)? version [12] [01]
zpl | zope | header | subject to the provisions of the zope public license
intel | intel | title | intel (?:simplified software|open source) license
nvidia | nvidia | notice | nvidia (?:software )?license agreement
amazon | amazon | title | amazon software license
facebook | grant | notice | additional grant of patent rights version 2 .{0,120}license
proprietary | confidential | notice | (?:proprietary and confidential|confidential and proprietary) .{0,80}(?:copyright|licen[sc]e|rights reserved)
proprietary | unauthorized | notice | unauthorized copying of this file via any medium is strictly prohibited .{0,120}(?:copyright|rights reserved)
proprietary | unpublished | notice | unpublished rights reserved under the copyright laws of the united states
""".strip().split("\n")


def signatures() -> list[tuple[str, str, str, int, float]]:
    """(regex, label, keyword, priority, confidence) of every line."""
    out = []
    for line in SIGNATURES:
        label, keyword, kind, regex = (x.strip() for x in line.split(" | ", 3))
        out.append((regex, label, keyword, *KINDS[kind]))
    return out
