"""Hand-written signatures of what licences, notices and grants say: label, priority, keyword and regex of each.

Regexes are in lower case; a blank stands for any run of blanks and comment leaders. A keyword is a word that every match
holds. Priorities: 85 for words that only one licence has, 75 for those of a notice or header, 55 for a clause that
several licences of a family share, 30 for what any of many licences says.
"""

#: Wording of public licences.
WORDING: tuple[tuple[str, int, str, str], ...] = (
    # MIT and its kin
    ("mit", 85, "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mit", 75, "restriction", r"to deal in the software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute"),
    ("mit", 55, "permission", r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies or substantial portions of the software"),
    ("mit", 55, "warrant", r"the software is provided \W?as is\W?,? without warranty of any kind, express or implied, including but not limited to"),
    ("mit-0", 85, "permission", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files \(the \W?software\W?\), to deal in the software without restriction, .{0,200}to permit persons to whom the software is furnished to do so\. the software is provided"),
    ("x11", 85, "x consortium", r"except as contained in this notice, the name of the x consortium shall not be used in advertising"),
    ("isc", 85, "permission", r"permission to use, copy, modify,? (?:and/or|and) distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", 55, "disclaims", r"the software is provided \W?as is\W? and (?:the author|isc) disclaims all warranties with regard to this software"),
    ("0bsd", 85, "permission", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted\. the software is provided"),
    ("hpnd", 85, "permission", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted"),
    ("ncsa", 85, "endorse", r"neither the names of .{1,120}nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission\. the software is provided"),
    # BSD
    ("bsd", 75, "redistribution", r"redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", 55, "redistribution", r"redistributions of source code must retain the (?:above )?copyright notice, this list of conditions and the following disclaimer"),
    ("bsd", 55, "redistribution", r"redistributions in binary form must reproduce the (?:above )?copyright notice, this list of conditions and the following disclaimer in the documentation"),
    ("bsd-3-clause", 85, "endorse", r"neither the names? of .{1,160}nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", 75, "endorse", r"the names? of the (?:author|company|copyright holder)s? may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", 85, "advertising", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause-clear", 85, "patent", r"no express or implied licenses to any party's patent rights are granted by this license"),
    ("bsd-3-clause-no-nuclear", 85, "nuclear", r"this software is not designed, licensed or intended for use in the design, construction, operation or maintenance of any nuclear facility"),
    ("bsd", 55, "warrant", r"this software is provided by .{1,120}\W?as is\W? and any express or implied warranties, including, but not limited to"),
    ("bsd", 55, "liable", r"in no event shall .{1,120}be liable for any direct, indirect, incidental, special, exemplary, or consequential damages"),
    ("bsd", 75, "license", r"use of this source code is governed by a bsd-style license"),
    # Apache
    ("apache-2.0", 85, "apache", r"licensed under the apache license, version 2\.0 \(the \W?license\W?\)"),
    ("apache-2.0", 85, "apache", r"you may obtain a copy of the license at https?://www\.apache\.org/licenses/license-2\.0"),
    ("apache-2.0", 75, "apache", r"apache license version 2\.0, january 2004"),
    ("apache", 55, "license", r"you may not use this file except in compliance with the license"),
    ("apache", 55, "license", r"unless required by applicable law or agreed to in writing, software distributed under the license is distributed on an \W?as is\W? basis"),
    ("apache-2.0", 75, "contributor", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable copyright license"),
    ("apache-2.0", 75, "patent", r"each contributor hereby grants to you a perpetual, worldwide, non-exclusive, no-charge, royalty-free, irrevocable \(except as stated in this section\) patent license"),
    ("apache-1.1", 85, "apache", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache-1.1", 75, "apache", r"the names \W?apache\W?(?: server\W?)? and \W?apache (?:software foundation|group)\W? must not be used to endorse"),
    ("llvm-exception", 85, "exception", r"llvm exceptions to the apache 2\.0 license"),
    # GNU
    ("gpl", 75, "general public license", r"this program is free software[:;]? you can redistribute it and/or modify it under the terms of the gnu general public license"),
    ("gpl-2-or-later", 85, "later version", r"gnu general public license,? as published by the free software foundation[;,] either version 2 of the license, or \(at your option\) any later version"),
    ("gpl-3-or-later", 85, "later version", r"gnu general public license,? as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("gpl-1-or-later", 85, "later version", r"gnu general public license,? as published by the free software foundation[;,] either version 1,? or \(at your option\) any later version"),
    ("gpl-2-only", 85, "version 2", r"gnu general public license version 2(?: only)?,? as published by the free software foundation(?! or)"),
    ("gpl-2-only", 85, "version 2", r"under the terms (?:and conditions )?of the gnu general public license,? version 2,? as published by the free software foundation"),
    ("gpl-3-only", 85, "version 3", r"gnu general public license,? version 3(?: only)?,? as published by the free software foundation(?! or)"),
    ("gpl", 55, "general public license", r"see the gnu general public license for more details"),
    ("gpl", 55, "general public license", r"you should have received a copy of the gnu general public license along with"),
    ("gpl-2", 85, "general public license", r"gnu general public license version 2, june 1991"),
    ("gpl-3", 85, "general public license", r"gnu general public license version 3, 29 june 2007"),
    ("gpl-2", 75, "freedom", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3", 75, "copyleft", r"the gnu general public license is a free, copyleft license for software and other kinds of works"),
    ("lgpl-2.1-or-later", 85, "lesser", r"gnu lesser general public license as published by the free software foundation[;,] either version 2\.1 of the license, or \(at your option\) any later version"),
    ("lgpl-3-or-later", 85, "lesser", r"gnu lesser general public license as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("lgpl-2-or-later", 85, "library", r"gnu library general public license as published by the free software foundation[;,] either version 2 of the license, or \(at your option\) any later version"),
    ("lgpl", 55, "lesser", r"see the gnu lesser general public license for more details"),
    ("lgpl", 55, "library", r"see the gnu library general public license for more details"),
    ("agpl-3-or-later", 85, "affero", r"gnu affero general public license as published by the free software foundation[;,] either version 3 of the license, or \(at your option\) any later version"),
    ("agpl", 55, "affero", r"see the gnu affero general public license for more details"),
    ("agpl-3", 85, "affero", r"gnu affero general public license version 3, 19 november 2007"),
    ("gfdl", 85, "documentation license", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("gfdl-no-invariants", 85, "invariant sections", r"with no invariant sections, no front-cover texts,? and no back-cover texts"),
    ("gpl-classpath-exception", 85, "linking", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-classpath-exception", 75, "classpath", r"subject to the \W?classpath\W? exception"),
    ("gpl-gcc-exception", 85, "exception", r"under section 7 of gpl version 3, you are granted additional permissions described in the gcc runtime library exception"),
    ("gpl-openssl-exception", 85, "openssl", r"permission to link (?:the code of )?(?:this program|portions of this program|the program) with the openssl (?:project's )?\W?openssl\W? library"),
    ("gpl-bison-exception", 85, "bison", r"as a special exception, you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-autoconf-exception", 85, "autoconf", r"as a special exception to the gnu general public license, if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-font-exception", 85, "font", r"as a special exception, if you create a document which uses this font"),
    ("gpl-linking-exception", 55, "exception", r"as a special exception, .{0,120}gives? (?:you )?permission to link"),
    # other copyleft
    ("mpl-2.0", 85, "mozilla", r"this source code form is subject to the terms of the mozilla public license, v\. 2\.0"),
    ("mpl-2.0", 75, "mpl", r"if a copy of the mpl was not distributed with this file, you can obtain one at"),
    ("mpl-2.0-no-copyleft-exception", 85, "incompatible", r"this source code form is \W?incompatible with secondary licenses\W?, as defined by the mozilla public license"),
    ("mpl-1.1", 85, "mozilla", r"the contents of this file are subject to the mozilla public license version 1\.1"),
    ("mpl-1.0", 85, "mozilla", r"the contents of this file are subject to the mozilla public license version 1\.0"),
    ("npl-1.1", 85, "netscape", r"the contents of this file are subject to the netscape public license version 1\.1"),
    ("epl-1.0", 85, "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1\.0"),
    ("epl-2.0", 85, "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v\.? ?| )2\.0"),
    ("cpl-1.0", 85, "common public", r"this program and the accompanying materials are made available under the terms of the common public license v1\.0"),
    ("cddl", 85, "common development", r"the contents of this file are subject to the terms of the common development and distribution license"),
    ("eupl", 85, "eupl", r"licensed under the eupl(?:,? version 1\.[0-2])?(?: only)?(?: \(the \W?licen[cs]e\W?\)| or)"),
    ("osl-3.0", 85, "open software license", r"licensed under the open software license version 3\.0"),
    ("afl-3.0", 85, "academic free", r"licensed under the academic free license version 3\.0"),
    ("cecill", 85, "cecill", r"this software is governed by the cecill(?:-[bc])? license under french law"),
    ("sspl", 85, "server side", r"server side public license version 1, october 16, 2018"),
    ("artistic-2.0", 85, "verbatim", r"everyone is permitted to copy and distribute verbatim copies of this license document, but changing it is not allowed\. preamble this license establishes the terms under which a given free software package"),
    ("artistic-1.0", 85, "artistic", r"the intent of this document is to state the conditions under which a package may be copied, such that the copyright holder maintains some semblance of artistic control"),
    # permissive, one of a kind
    ("zlib", 85, "warrant", r"this software is provided \W?as-is\W?, without any express or implied warranty\. in no event will the authors be held liable"),
    ("zlib", 75, "origin", r"the origin of this software must not be misrepresented; you must not claim that you wrote the original software"),
    ("zlib", 55, "altered", r"altered source versions must be plainly marked as such, and must not be misrepresented as being the original software"),
    ("bsl-1.0", 85, "boost", r"distributed under the boost software license, version 1\.0"),
    ("bsl-1.0", 85, "permission", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("unlicense", 85, "public domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 75, "compile", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary"),
    ("wtfpl", 85, "fuck", r"you just do what the fuck you want to"),
    ("beerware", 85, "retain", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("postgresql", 85, "permission", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted"),
    ("python", 85, "psf", r"psf hereby grants licensee a nonexclusive, royalty-free, world-wide license"),
    ("php-3.01", 85, "php", r"this source file is subject to version 3\.01 of the php license"),
    ("ruby", 85, "verbatim", r"you may make and give away verbatim copies of the source form of the software without restriction, provided that you duplicate all of the original copyright notices"),
    ("openssl", 85, "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 85, "cryptographic", r"this product includes cryptographic software written by eric young"),
    ("w3c", 85, "licensee", r"by obtaining(?:, using and/or copying)? this work, you \(the licensee\) agree that you have read, understood, and will comply with the following terms"),
    ("upl-1.0", 85, "permission", r"subject to the condition set forth below, permission is hereby granted to any person obtaining a copy of this software"),
    ("icu", 85, "permission", r"provided that the above copyright notice\(s\) and this permission notice appear in all copies of the software and that both the above copyright notice\(s\)"),
    ("unicode", 85, "data files", r"permission is hereby granted, free of charge, to any person obtaining a copy of (?:the unicode )?data files and any associated documentation"),
    ("curl", 85, "permission", r"permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies\. the software is provided"),
    ("libpng", 85, "png", r"the png reference library is supplied \W?as is\W?"),
    ("ijg", 85, "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", 85, "freetype", r"portions of this software are copyright .{1,60}the freetype project"),
    ("json", 85, "evil", r"the software shall be used for good, not evil"),
    ("ms-pl", 85, "accept this license", r"this license governs use of the accompanying software\. if you use the software, you accept this license"),
    # fonts, data, works
    ("ofl-1.1", 85, "font software", r"this font software is licensed under the sil open font license, version 1\.1"),
    ("ofl", 75, "reserved font", r"with reserved font names?"),
    ("cc-by", 85, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution(?: [1-4]\.[05])?(?: international| unported)? license"),
    ("cc-by-sa", 85, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution[ -]share ?alike"),
    ("cc-by-nc", 85, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution[ -]non-?commercial"),
    ("cc-by-nd", 85, "creative commons", r"this work is licensed under (?:a|the) creative commons attribution[ -]no ?deriv"),
    ("cc", 75, "creativecommons", r"creativecommons\.org/licenses/(?:by|nc|nd|sa|by-[a-z-]+)/[1-4]\.[05]"),
    ("cc0", 85, "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("cc0", 85, "waived", r"to the extent possible under law, .{1,120}waived all copyright and related or neighbou?ring rights"),
    ("odbl", 85, "open database", r"made available under the open database license"),
    ("odc-by", 85, "open data commons", r"made available under the open data commons attribution license"),
    ("public-domain", 75, "public domain", r"(?:this (?:file|code|software|work|program)|the author) (?:is|has been|was|hereby)?(?: placed| released| dedicated| puts?| places?)? ?(?:this (?:file|code|software|work) )?(?:in|into|to) the public domain"),
    # source-available and proprietary
    ("busl-1.1", 85, "business source", r"use of this software is governed by the business source license"),
    ("busl-1.1", 75, "change date", r"change date: .{1,40}change license:"),
    ("elastic-2.0", 85, "elastic", r"licensed under the elastic license 2\.0; you may not use this file except in compliance"),
    ("commons-clause", 85, "sell the software", r"the license does not grant to you, the right to sell the software"),
    ("polyform-noncommercial", 85, "polyform", r"polyform noncommercial license 1\.0\.0"),
    ("proprietary", 55, "confidential", r"(?:confidential and proprietary|proprietary and confidential)"),
    ("proprietary", 55, "prohibited", r"unauthori[sz]ed (?:copying|use|reproduction|distribution).{0,80}is strictly prohibited"),
    ("proprietary", 75, "agreement", r"end[ -]user licen[sc]e agreement"),
    ("all-rights-reserved", 30, "rights reserved", r"all rights reserved"),
    # what many say
    ("copyright-notice", 30, "copyright", r"copyright (?:\(c\)|©|&copy;)? ?(?:19|20)[0-9][0-9]"),
    ("warranty-disclaimer", 30, "warrant", r"without (?:even the implied |any express or implied |any )?warranty (?:of any kind|of merchantability)?"),
    ("warranty-disclaimer", 30, "merchantability", r"warrant(?:y|ies) of merchantability,? (?:and|or)? ?fitness for a particular purpose"),
    ("liability-disclaimer", 30, "liable", r"in no event (?:shall|will) .{1,80}be (?:held )?liable"),
    ("no-endorsement", 30, "endorse", r"used to endorse or promote products"),
    ("dual-license", 75, "dual", r"dual[ -]licensed under"),
    ("license-file", 30, " for ", r"(?:see|refer to) (?:the )?(?:accompanying )?(?:file )?(?:license|copying)(?:\.txt|\.md)?(?: file)? for (?:details|license|licensing|copying|more)"),
)

#: Every signature's regex holds one of these: a text without any of them is not tried.
WORDING_GATES = ("licen", "software", "copyright", "exception", "permission", "warrant", "liable", "endorse", "notice", "redistribut", "public domain", "rights", "prohibited", "reserved", "publicdomain", "invariant", "linking", "fuck", "png", "mpl", "confidential", "copying")
