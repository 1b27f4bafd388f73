"""Signature rules for licences, as a table to be edited by hand.

A line is: label, priority from 1 to 100, regular expression. The expression runs over the words of a text
in lower case, joined by single spaces, and matches whole words. A line "= keyword" starts a block:
its rules run only on texts that hold the keyword. Between rules of equal priority the order counts.
Priorities: 95 tags and addresses, 85 full titles, 70 notices, 55 short names, 35 hints.
"""

TABLE = r"""
= spdx
apache-2.0 95 spdx license identifier apache 2 0
apache-1.1 95 spdx license identifier apache 1 1
mit 95 spdx license identifier mit
mit-0 95 spdx license identifier mit 0
bsd-2-clause 95 spdx license identifier bsd 2 clause
bsd-3-clause 95 spdx license identifier bsd 3 clause(?: clear)?
bsd-4-clause 95 spdx license identifier bsd 4 clause
0bsd 95 spdx license identifier 0bsd
gpl-2.0 95 spdx license identifier gpl 2 0(?: only| or later)?
gpl-3.0 95 spdx license identifier gpl 3 0(?: only| or later)?
lgpl-2.0 95 spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 95 spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-3.0 95 spdx license identifier lgpl 3 0(?: only| or later)?
agpl-3.0 95 spdx license identifier agpl 3 0(?: only| or later)?
mpl-1.1 95 spdx license identifier mpl 1 1
mpl-2.0 95 spdx license identifier mpl 2 0(?: no copyleft exception)?
epl-1.0 95 spdx license identifier epl 1 0
epl-2.0 95 spdx license identifier epl 2 0
cddl-1.0 95 spdx license identifier cddl 1 0
isc 95 spdx license identifier isc
zlib 95 spdx license identifier zlib
unlicense 95 spdx license identifier unlicense
cc0-1.0 95 spdx license identifier cc0 1 0
cc-by-4.0 95 spdx license identifier cc by 4 0
cc-by-sa-4.0 95 spdx license identifier cc by sa 4 0
cc-by-nc-4.0 95 spdx license identifier cc by nc 4 0
cc-by-nd-4.0 95 spdx license identifier cc by nd 4 0
bsl-1.0 95 spdx license identifier bsl 1 0
artistic-2.0 95 spdx license identifier artistic 2 0
eupl-1.2 95 spdx license identifier eupl 1 2
ofl-1.1 95 spdx license identifier ofl 1 1
wtfpl 95 spdx license identifier wtfpl
postgresql 95 spdx license identifier postgresql
python-2.0 95 spdx license identifier python 2 0
upl-1.0 95 spdx license identifier upl 1 0
ncsa 95 spdx license identifier ncsa
other 35 spdx license identifier [^ ]+
= apache
apache-2.0 95 (?:www )?apache org licenses license 2 0(?: txt| html)?
apache-2.0 85 apache licen[sc]e version 2(?: 0)?
apache-2.0 85 apache licen[sc]e v ?2(?: 0)?
apache-2.0 85 apache 2(?: 0)? licen[sc]e
apache-2.0 85 apache software licen[sc]e version 2(?: 0)?
apache-2.0 55 apache licen[sc]e 2(?: 0)?
apache-1.1 85 apache software licen[sc]e version 1 1
apache-1.0 85 apache licen[sc]e version 1 0
apache-2.0 70 licensed under the apache licen[sc]e version 2(?: 0)? the license you may not use this file except in compliance with the license
apache 70 (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?apache (?:software )?licen[sc]e
apache 55 apache software licen[sc]e
= mit
mit 95 (?:www )?opensource org licenses mit(?: license)?(?: php| html)?
mit 95 choosealicense com licenses mit
mit 85 the mit licen[sc]e(?: mit)?
mit 85 mit licen[sc]e copyright
mit 70 (?:licensed|released|distributed|available) under (?:the )?(?:terms of the )?mit licen[sc]e
mit 70 dual licensed under (?:the )?mit and [^ ]+(?: [^ ]+)? licenses?
mit-0 85 mit no attribution(?: licen[sc]e)?
= bsd
bsd-2-clause 95 (?:www )?opensource org licenses bsd 2 clause
bsd-3-clause 95 (?:www )?opensource org licenses bsd 3 clause
bsd 95 (?:www )?opensource org licenses bsd license(?: php)?
bsd-2-clause 85 (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: simplified)? licen[sc]e
bsd-3-clause 85 (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd) licen[sc]e
bsd-4-clause 85 (?:original bsd|bsd 4 clause|4 clause bsd|four clause bsd) licen[sc]e
0bsd 85 (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)?
bsd 70 (?:licensed|released|distributed|available) under (?:the |a )?bsd(?: style)? licen[sc]e
bsd 70 use of this source code is governed by a bsd style licen[sc]e
bsd 55 bsd licen[sc]e
bsd 35 bsd style
= redistribution
bsd 70 redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
= gnu
gpl-3.0 95 (?:www )?gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
gpl-2.0 95 (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
lgpl-2.1 95 (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
lgpl-3.0 95 (?:www )?gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?
agpl-3.0 95 (?:www )?gnu org licenses agpl 3 0(?: en)?(?: html| txt)?
gfdl 95 (?:www )?gnu org licenses fdl(?: 1 [123])?(?: en)?(?: html| txt)?
gpl 95 (?:www )?gnu org licenses gpl(?: html)?
gnu-site 35 (?:www )?gnu org licenses
gpl-3.0 85 gnu general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 3(?: 0)?
gpl-2.0 85 gnu general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 2(?: 0)?
gpl-1.0 85 gnu general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 1(?: 0)?
gpl-3.0 85 gnu gpl ?(?:version |v ?)?3(?: 0)?
gpl-2.0 85 gnu gpl ?(?:version |v ?)?2(?: 0)?
lgpl-3.0 85 gnu lesser general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 3(?: 0)?
lgpl-2.1 85 gnu lesser general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 2 1
lgpl-2.0 85 gnu library general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 2(?: 0)?
agpl-3.0 85 gnu affero general public licen[sc]e (?:as published by the free software foundation either )?(?:version|v) 3(?: 0)?
gfdl-1.3 85 gnu free documentation licen[sc]e (?:version|v) 1 3
gfdl-1.2 85 gnu free documentation licen[sc]e (?:version|v) 1 2
gfdl-1.1 85 gnu free documentation licen[sc]e (?:version|v) 1 1
lgpl 70 gnu lesser general public licen[sc]e
lgpl 70 gnu library general public licen[sc]e
agpl 70 gnu affero general public licen[sc]e
gfdl 70 gnu free documentation licen[sc]e
gpl 70 it under the terms of the gnu general public licen[sc]e
gpl 70 licensed under (?:the )?(?:terms of the )?gnu general public licen[sc]e
gpl 55 gnu general public licen[sc]e
gpl 55 gnu public licen[sc]e
gpl 55 gnu gpl
lgpl 55 gnu lgpl
agpl 55 gnu agpl
= gpl
gpl-3.0 55 gpl ?(?:version |v ?)3(?: 0)?
gpl-2.0 55 gpl ?(?:version |v ?)2(?: 0)?
gpl-3.0 55 gpl 3 0(?: or later)?
gpl-2.0 55 gpl 2 0(?: or later)?
gpl-3.0 55 gplv3
gpl-2.0 55 gplv2
lgpl-3.0 55 lgplv3
lgpl-2.1 55 lgplv2 1
lgpl-2.0 55 lgplv2
agpl-3.0 55 agplv3
lgpl-2.1 55 lgpl (?:version |v )?2 1
lgpl-3.0 55 lgpl (?:version |v )?3(?: 0)?
agpl-3.0 55 agpl (?:version |v )?3(?: 0)?
gpl 35 (?:licensed|released|distributed|available) under (?:the )?gpl
lgpl 35 (?:licensed|released|distributed|available) under (?:the )?lgpl
agpl 35 (?:licensed|released|distributed|available) under (?:the )?agpl
= mozilla
mpl-2.0 95 (?:www )?mozilla org (?:en us )?mpl 2 0
mpl-1.1 95 (?:www )?mozilla org mpl mpl 1 1(?: html| txt)?
mpl 95 (?:www )?mozilla org mpl
mpl-2.0 85 mozilla public licen[sc]e (?:version |v ?)?2 0
mpl-1.1 85 mozilla public licen[sc]e (?:version |v ?)?1 1
mpl-1.0 85 mozilla public licen[sc]e (?:version |v ?)?1 0
mpl-2.0 70 this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
mpl 55 mozilla public licen[sc]e
= mpl
mpl-2.0 55 mpl ?(?:version |v ?)?2 0
mpl-1.1 55 mpl ?(?:version |v ?)?1 1
= eclipse
epl-2.0 95 (?:www )?eclipse org legal epl 2 0
epl-1.0 95 (?:www )?eclipse org legal epl v10(?: html)?
epl-2.0 85 eclipse public licen[sc]e (?:version |v ?)?2 0
epl-1.0 85 eclipse public licen[sc]e (?:version |v ?)?1 0
edl-1.0 85 eclipse distribution licen[sc]e (?:version |v ?)?1 0
epl 55 eclipse public licen[sc]e
edl 55 eclipse distribution licen[sc]e
= cddl
cddl-1.0 55 cddl (?:version |v )?1 0
cddl-1.1 55 cddl (?:version |v )?1 1
= common development
cddl-1.1 85 common development and distribution licen[sc]e (?:cddl )?(?:version |v )?1 1
cddl-1.0 85 common development and distribution licen[sc]e (?:cddl )?(?:version |v )?1 0
cddl 55 common development and distribution licen[sc]e
= common public
cpl-1.0 85 common public licen[sc]e (?:version |v )?1 0
cpl 55 common public licen[sc]e
cpal-1.0 85 common public attribution licen[sc]e(?: (?:version |v )?1 0)?
= creativecommons
cc-by-4.0 95 (?:www )?creativecommons org licenses by 4 0
cc-by-3.0 95 (?:www )?creativecommons org licenses by 3 0
cc-by-2.5 95 (?:www )?creativecommons org licenses by 2 5
cc-by-2.0 95 (?:www )?creativecommons org licenses by 2 0
cc-by-sa-4.0 95 (?:www )?creativecommons org licenses by sa 4 0
cc-by-sa-3.0 95 (?:www )?creativecommons org licenses by sa 3 0
cc-by-sa-2.5 95 (?:www )?creativecommons org licenses by sa 2 5
cc-by-nc-4.0 95 (?:www )?creativecommons org licenses by nc 4 0
cc-by-nc-3.0 95 (?:www )?creativecommons org licenses by nc 3 0
cc-by-nd-4.0 95 (?:www )?creativecommons org licenses by nd 4 0
cc-by-nd-3.0 95 (?:www )?creativecommons org licenses by nd 3 0
cc-by-nc-sa-4.0 95 (?:www )?creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 95 (?:www )?creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 95 (?:www )?creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 95 (?:www )?creativecommons org licenses by nc nd 3 0
cc0-1.0 95 (?:www )?creativecommons org publicdomain zero 1 0
cc-pdm 95 (?:www )?creativecommons org publicdomain mark 1 0
cc 35 (?:www )?creativecommons org
= creative commons
cc-by-nc-nd 85 creative commons attribution non ?commercial no ?deriv(?:atives?|s)(?: works)?(?: [1-4] [05])?
cc-by-nc-sa 85 creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?
cc-by-nc 85 creative commons attribution non ?commercial(?: [1-4] [05])?
cc-by-nd 85 creative commons attribution no ?deriv(?:atives?|s)(?: works)?(?: [1-4] [05])?
cc-by-sa 85 creative commons attribution share ?alike(?: [1-4] [05])?
cc-by-4.0 85 creative commons attribution 4 0(?: international)?
cc-by-3.0 85 creative commons attribution 3 0(?: unported)?
cc-by 85 creative commons attribution
cc0-1.0 85 creative commons (?:zero|cc0)(?: v?1 0)?(?: universal)?
cc 35 creative commons licen[sc]e
= cc by
cc-by-nc-nd 55 cc by nc nd(?: [1-4] [05])?
cc-by-nc-sa 55 cc by nc sa(?: [1-4] [05])?
cc-by-nc 55 cc by nc(?: [1-4] [05])?
cc-by-nd 55 cc by nd(?: [1-4] [05])?
cc-by-sa 55 cc by sa(?: [1-4] [05])?
cc-by-4.0 55 cc by 4 0
cc-by-3.0 55 cc by 3 0
cc-by-2.0 55 cc by 2 0
cc-by 35 cc by
= cc0
cc0-1.0 55 cc0(?: 1 0)?(?: universal)?
= public domain
public-domain 70 (?:this (?:work|file|software|code) is|released|placed|dedicated) (?:in|into|to) the public domain
public-domain 35 public domain
= unlicense
unlicense 95 (?:www )?unlicense org
unlicense 85 the unlicense
= isc
isc 85 isc licen[sc]e
= zlib
zlib 85 zlib(?: libpng)? licen[sc]e
= warranty
zlib 70 this software is provided as is without any express or implied warranty in no event will the authors be held liable
as-is 35 the software is provided as is without warranty of any kind
no-warranty 35 without any warranty without even the implied warranty of merchantability
= boost
bsl-1.0 95 (?:www )?boost org license 1 0 txt
bsl-1.0 85 boost software licen[sc]e(?: version 1 0| 1 0)?
= artistic
artistic-2.0 85 artistic licen[sc]e (?:version |v )?2(?: 0)?
artistic-1.0 85 artistic licen[sc]e (?:version |v )?1(?: 0)?
artistic 55 artistic licen[sc]e
= perl
perl 70 under the same terms as perl itself
= european union
eupl-1.2 85 european union public licen[sc]e (?:version |v )?1 2
eupl-1.1 85 european union public licen[sc]e (?:version |v )?1 1
eupl 55 european union public licen[sc]e
= sil
ofl-1.1 95 scripts sil org ofl
ofl-1.1 85 sil open font licen[sc]e(?: (?:version |v )?1 1)?
= open data commons
odbl-1.0 85 open data commons open database licen[sc]e(?: (?:odbl )?v?1 0)?
odc-by-1.0 85 open data commons attribution licen[sc]e(?: v?1 0)?
pddl-1.0 85 open data commons public domain dedication(?: and licen[sc]e)?
= opendatacommons
odbl-1.0 95 (?:www )?opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 95 (?:www )?opendatacommons org licenses by(?: 1 0)?
pddl-1.0 95 (?:www )?opendatacommons org licenses pddl(?: 1 0)?
= microsoft
ms-pl 85 microsoft public licen[sc]e
ms-rl 85 microsoft reciprocal licen[sc]e
= academic
afl-3.0 85 academic free licen[sc]e (?:version |v )?3 0
afl 55 academic free licen[sc]e
= open software
osl-3.0 85 open software licen[sc]e (?:version |v )?3 0
osl 55 open software licen[sc]e
= postgresql
postgresql 85 postgresql licen[sc]e
= python
python-2.0 85 python software foundation licen[sc]e(?: version 2)?
= php
php-3.01 85 php licen[sc]e (?:version |v )?3 01
php 55 php licen[sc]e
= ruby
ruby 85 ruby licen[sc]e
= openssl
openssl 85 openssl licen[sc]e
= w3c
w3c 85 w3c software (?:notice and )?licen[sc]e
= unicode
unicode 85 unicode licen[sc]e(?: agreement)?
= universal permissive
upl-1.0 85 universal permissive licen[sc]e(?: (?:version |v )?1 0)?
= server side
sspl-1.0 85 server side public licen[sc]e(?: (?:version |v )?1)?
= business source
busl-1.1 85 business source licen[sc]e(?: (?:version |v )?1 1)?
= elastic
elastic-2.0 85 elastic licen[sc]e(?: (?:version |v )?2 0)?
= openrail
openrail 85 (?:creativeml |bigscience )?openrail(?: m)?(?: licen[sc]e)?
= what the fuck
wtfpl 85 do what the fuck you want to public licen[sc]e
= licen
proprietary 70 proprietary (?:and confidential )?licen[sc]e
commercial 70 commercial licen[sc]e(?: agreement)?
eula 70 end user licen[sc]e agreement
copyleft 35 copyleft licen[sc]e
see-license 35 see (?:the )?licen[sc]e (?:file )?(?:for|in) [^ ]+
licensed-under 35 (?:is |are )?licensed under (?:the )?[^ ]+
= rights reserved
all-rights-reserved 70 all rights reserved
some-rights-reserved 55 some rights reserved
= copyright
copyright-notice 35 copyright (?:c )?(?:19|20)[0-9]{2}
= unencumbered
unlicense 70 this is free and unencumbered software released into the public domain
= permission to use
isc 70 permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
= permission is hereby
mit 70 permission is hereby granted free of charge to any person obtaining a copy of this software
= neither the name
bsd-3-clause 70 neither the name of (?:[^ ]+ ){1,20}nor the names of its contributors may be used to endorse or promote products
= advertising materials
bsd-4-clause 70 all advertising materials mentioning features or use of this software must display the following acknowledge?ment
= educational community
ecl-2.0 85 educational community licen[sc]e (?:version |v )?2 0
= x11
x11 85 x11 licen[sc]e
= expat
expat 85 expat licen[sc]e
"""
