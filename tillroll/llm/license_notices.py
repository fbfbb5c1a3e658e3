"""Wording of common licenses: short notices, standard headers and full texts, by SPDX identifier.

A notice is (identifier, text, deciding phrases): name, variant and version of
a license, each of which has to stand in the document with no word between.
"""

from __future__ import annotations

from pathlib import Path

Notice = tuple[str, str, tuple[str, ...]]

# Names in running text.
NAMES = (
    ("MIT", "MIT License"), ("MIT-0", "MIT No Attribution License"), ("MIT-0", "MIT-0 License"),
    ("Apache-2.0", "Apache License, Version 2.0"), ("Apache-2.0", "Apache License 2.0"), ("Apache-2.0", "Apache 2.0 License"),
    ("Apache-1.1", "Apache License, Version 1.1"), ("Apache-1.1", "Apache Software License, Version 1.1"),
    ("Apache-1.0", "Apache License, Version 1.0"),
    ("BSD-2-Clause", "BSD 2-Clause License"), ("BSD-2-Clause", "2-Clause BSD License"),
    ("BSD-2-Clause", "Simplified BSD License"), ("BSD-3-Clause", "BSD 3-Clause License"),
    ("BSD-3-Clause", "3-Clause BSD License"), ("BSD-3-Clause", "New BSD License"), ("BSD-3-Clause", "Modified BSD License"),
    ("BSD-3-Clause-Clear", "BSD 3-Clause Clear License"), ("BSD-4-Clause", "BSD 4-Clause License"),
    ("BSD-4-Clause", "4-Clause BSD License"), ("BSD-4-Clause", "Original BSD License"), ("0BSD", "Zero-Clause BSD License"),
    ("0BSD", "BSD Zero-Clause License"), ("ISC", "ISC License"), ("Zlib", "zlib License"), ("Unlicense", "Unlicense"),
    ("BSL-1.0", "Boost Software License, Version 1.0"), ("BSL-1.0", "Boost Software License 1.0"),
    ("EPL-1.0", "Eclipse Public License, Version 1.0"), ("EPL-1.0", "Eclipse Public License v1.0"),
    ("EPL-2.0", "Eclipse Public License, Version 2.0"), ("EPL-2.0", "Eclipse Public License 2.0"),
    ("EPL-2.0", "Eclipse Public License v2.0"), ("CDDL-1.0", "Common Development and Distribution License, Version 1.0"),
    ("MPL-1.1", "Mozilla Public License, Version 1.1"), ("MPL-1.1", "Mozilla Public License 1.1"),
    ("MPL-2.0", "Mozilla Public License, Version 2.0"), ("MPL-2.0", "Mozilla Public License 2.0"),
    ("MPL-2.0", "Mozilla Public License, v. 2.0"), ("Artistic-1.0", "Artistic License 1.0"),
    ("Artistic-2.0", "Artistic License 2.0"), ("CC0-1.0", "CC0 1.0 Universal"), ("CC0-1.0", "CC0 1.0 Universal Public Domain Dedication"),
)
# The GNU licenses: identifier, kind and version.
GNU = (
    ("GPL-1.0", "General", "1"), ("GPL-2.0", "General", "2"), ("GPL-3.0", "General", "3"), ("AGPL-3.0", "Affero General", "3"),
    ("LGPL-2.0", "Library General", "2"), ("LGPL-2.0", "Lesser General", "2"), ("LGPL-2.1", "Lesser General", "2.1"),
    ("LGPL-3.0", "Lesser General", "3"),
)
FREE = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} Public License as "
    "published by the Free Software Foundation, either version {version} of the License, or (at your option) any later version. "
    "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
    "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} Public License for more details."
)
# Creative Commons: the variant in short and in full.
COMMONS = (
    ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)
TAGS = (
    "MIT", "MIT-0", "Apache-2.0", "Apache-1.1", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "0BSD", "ISC",
    "Zlib", "Unlicense", "BSL-1.0", "EPL-1.0", "EPL-2.0", "CDDL-1.0", "MPL-1.1", "MPL-2.0", "Artistic-1.0", "Artistic-2.0", "CC0-1.0",
    "GPL-1.0", "GPL-2.0", "GPL-3.0", "AGPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0",
    *(f"CC-{short}-{version}" for short, _ in COMMONS for version in ("2.0", "2.5", "3.0", "4.0")),
)

GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software, and to permit persons to whom the Software is furnished to do so"
)
KEEP = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be included in all "
    "copies or substantial portions of the Software. "
)
AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE "
    "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
    "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, "
    "ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
)
ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following acknowledgement: This "
    "product includes software developed by the organization. "
)
ENDORSE = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission. "
)
BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, "
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF "
    "USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT "
    "LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED "
    "OF THE POSSIBILITY OF SUCH DAMAGE."
)
ANY_PURPOSE = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
)
ISC_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies"
AUTHOR_DISCLAIMS = (
    ". THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN "
    "ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF "
    "THIS SOFTWARE."
)
PERMISSIVE = (
    ("MIT", GRANT + KEEP + AS_IS, ("this permission notice shall be included",)),
    ("MIT-0", GRANT + ". " + AS_IS, ()),
    ("X11", GRANT + KEEP + AS_IS + " Except as contained in this notice, the name of the X Consortium shall not be used in "
     "advertising or otherwise to promote the sale, use or other dealings in this Software without prior written "
     "authorization from the X Consortium.", ("except as contained in this notice",)),
    ("JSON", GRANT + KEEP + "The Software shall be used for Good, not Evil. " + AS_IS, ("good not evil",)),
    ("BSD-2-Clause", BSD, ()),
    ("BSD-2-Clause", BSD + BSD_AS_IS, ()),
    ("BSD-3-Clause", BSD + ENDORSE + BSD_AS_IS, ("endorse or promote products",)),
    ("BSD-4-Clause", BSD + ADVERTISING + ENDORSE, ("advertising materials mentioning features", "endorse or promote products")),
    ("BSD-4-Clause", BSD + ADVERTISING + ENDORSE + BSD_AS_IS, ("advertising materials mentioning features", "endorse or promote products")),
    ("ISC", ANY_PURPOSE + ISC_KEEP + AUTHOR_DISCLAIMS, ("this permission notice appear in all copies",)),
    ("ISC", ANY_PURPOSE + ISC_KEEP, ("this permission notice appear in all copies",)),
    ("0BSD", ANY_PURPOSE + AUTHOR_DISCLAIMS, ("is hereby granted the software is provided",)),
    (
        "Zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable "
        "for any damages arising from the use of this software. Permission is granted to anyone to use this software for any "
        "purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following "
        "restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original "
        "software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated "
        "but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as "
        "being the original software. 3. This notice may not be removed or altered from any source distribution.", (),
    ),
    (
        "Unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
        "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, "
        "commercial or non-commercial, and by any means.", (),
    ),
    (
        "BSL-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
        "accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, distribute, execute, "
        "and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the "
        "Software is furnished to do so, all subject to the following: The copyright notices in the Software and this entire "
        "statement, including the above license grant, this restriction and the following disclaimer, must be included in all "
        "copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative "
        "works are solely in the form of machine-executable object code generated by a source language processor.", (),
    ),
)
# Files of full texts, with their identifier and the title that decides.
FULL = (
    ("Apache-2.0", "Apache-2.0", "Apache License Version 2.0"), ("GPL-1.0", "GPL-1", "GNU General Public License Version 1"),
    ("GPL-2.0", "GPL-2", "GNU General Public License Version 2"), ("GPL-3.0", "GPL-3", "GNU General Public License Version 3"),
    ("LGPL-2.0", "LGPL-2", "GNU Library General Public License Version 2"),
    ("LGPL-2.1", "LGPL-2.1", "GNU Lesser General Public License Version 2.1"),
    ("LGPL-3.0", "LGPL-3", "GNU Lesser General Public License Version 3"), ("MPL-1.1", "MPL-1.1", "Mozilla Public License Version 1.1"),
    ("MPL-2.0", "MPL-2.0", "Mozilla Public License Version 2.0"), ("CC0-1.0", "CC0-1.0", "CC0 1.0 Universal"),
    ("GFDL-1.2", "GFDL-1.2", "GNU Free Documentation License Version 1.2"),
    ("GFDL-1.3", "GFDL-1.3", "GNU Free Documentation License Version 1.3"), ("Artistic-1.0", "Artistic", "Artistic License"),
)


def short_notices() -> list[Notice]:
    """One-line notices with the name of each license in the ways it is written."""
    gnu = [(name, f"GNU {kind} Public License{sep}version {version}") for name, kind, version in GNU for sep in (", ", " ")]
    gnu += [(name, f"GNU {kind} Public License v{version}") for name, kind, version in GNU]
    out = [
        (name, form.format(said), (said,))
        for name, said in (*NAMES, *gnu) for form in ("Released under the {}.", "Licensed under the {}.")
    ]
    out += [(name, f"This work is licensed under the {said}.", (said,)) for name, said in gnu]
    # These stand on their own as well; the abbreviations follow a phrase.
    out += [(name, said, (said,)) for name, said in gnu]
    for name, _, version in GNU:
        out += [(name, f"{name}-{tail}", (f"{name}-{tail}",)) for tail in ("only", "or-later")]
        family = name.split("-")[0]
        for short in (f"{family}v{version}", f"{family} v{version}", f"{family} version {version}"):
            out += [
                (name, form.format(short), (short,))
                for form in ("Licensed under {}.", "Licensed under the {}.", "Released under {}.", "Released under the {}.")
            ]
    for short, full in COMMONS:
        for version in ("2.0", "2.5", "3.0", "4.0"):
            name = f"CC-{short}-{version}"
            out += [(name, f"{how} under CC {short} {version}.", (f"CC {short} {version}",)) for how in ("Licensed", "Released")]
            said = f"Creative Commons {full} {version}"
            for kind in ("International", "Unported", "Generic"):
                out.append((name, f"This work is licensed under a {said} {kind} License.", (said,)))
    out += [(name, f"SPDX-License-Identifier: {name}", (f"SPDX-License-Identifier: {name}",)) for name in TAGS]
    return list(dict.fromkeys(out))


def headers() -> list[Notice]:
    return [
        (name, FREE.format(what=what, kind=kind, version=version), (f"GNU {kind} Public License", f"version {version} of the License"))
        for name, kind, version in GNU for what in ("program", "library")
    ]


def full_texts() -> list[Notice]:
    folder = Path(__file__).parent / "license_texts"
    return [(name, (folder / f"{file}.txt").read_text("utf-8"), (title,)) for name, file, title in FULL]
