"""Published wording of licences: names, statements, notices and texts (fixed values).

``PASSAGES``: a licence and a passage that states it, as published. Copyright lines and addresses
are left out; sentences that no passage has may stand between those that it has.
"""

# SPDX identifier -> names under which statements refer to the licence.
NAMES = {
    "MIT": ("MIT License", "MIT Licence", "MIT", "Expat License"),
    "MIT-0": ("MIT No Attribution License", "MIT-0"),
    "ISC": ("ISC License", "ISC"),
    "0BSD": ("BSD Zero Clause License", "0BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause License", "Simplified BSD License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause License", "New BSD License", "BSD-3-Clause"),
    "Apache-2.0": ("Apache License, Version 2.0", 'Apache License, Version 2.0 (the "License")', "Apache License 2.0",
                   "Apache 2.0 License", "Apache 2.0", "Apache-2.0"),
    "GPL-2.0-only": ("GNU General Public License, version 2", "GNU General Public License v2.0", "GPLv2", "GPL-2.0-only"),
    "GPL-2.0-or-later": ("GNU General Public License, version 2 or later", "GPLv2+", "GPL-2.0-or-later"),
    "GPL-3.0-only": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3", "GPL-3.0-only"),
    "GPL-3.0-or-later": ("GNU General Public License, version 3 or later", "GPLv3+", "GPL-3.0-or-later"),
    "LGPL-2.1-only": ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1-only"),
    "LGPL-2.1-or-later": ("GNU Lesser General Public License, version 2.1 or later", "LGPLv2.1+", "LGPL-2.1-or-later"),
    "LGPL-3.0-only": ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0-only"),
    "LGPL-3.0-or-later": ("GNU Lesser General Public License, version 3 or later", "LGPLv3+", "LGPL-3.0-or-later"),
    "AGPL-3.0-only": ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0-only"),
    "AGPL-3.0-or-later": ("GNU Affero General Public License, version 3 or later", "AGPLv3+", "AGPL-3.0-or-later"),
    "MPL-2.0": ("Mozilla Public License, v. 2.0", "Mozilla Public License 2.0", "Mozilla Public License, version 2.0", "MPL-2.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License v. 2.0", "EPL-2.0"),
    "BSL-1.0": ("Boost Software License, Version 1.0", "BSL-1.0"),
    "Zlib": ("zlib License", "zlib"),
    "Unlicense": ("Unlicense",),
    "OFL-1.1": ("SIL Open Font License, Version 1.1", "OFL-1.1"),
    "CC0-1.0": ("CC0 1.0", "CC0", "Creative Commons Zero v1.0 Universal", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License", "a Creative Commons Attribution 4.0 International License"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License",
                     "a Creative Commons Attribution-ShareAlike 4.0 International License"),
    "CC-BY-SA-3.0": ("CC BY-SA 3.0", "Creative Commons Attribution-ShareAlike 3.0 Unported License",
                     "a Creative Commons Attribution-ShareAlike 3.0 Unported License"),
    "CC-BY-ND-4.0": ("CC BY-ND 4.0", "a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License",
                     "a Creative Commons Attribution-NonCommercial 4.0 International License"),
    "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0", "a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License"),
    "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0", "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License"),
}

# Identifiers that SPDX has replaced, and what they mean.
REPLACED = {"GPL-2.0": "GPL-2.0-only", "GPL-3.0": "GPL-3.0-only", "LGPL-2.1": "LGPL-2.1-only",
            "LGPL-3.0": "LGPL-3.0-only", "AGPL-3.0": "AGPL-3.0-only"}

# What comes before a name, with or without "the", in a statement.
STATEMENTS = (
    "Licensed under", "Released under", "Distributed under", "Published under", "Available under", "Made available under",
    "Licensed under the terms of", "Released under the terms of", "Distributed under the terms of",
    "This work is licensed under", "This project is licensed under", "This software is licensed under",
    "This program is licensed under", "This code is licensed under", "This file is licensed under",
    "This library is licensed under", "This package is licensed under", "This document is licensed under",
    "This project is released under", "This software is released under", "This code is released under",
    "The code is licensed under", "Content is licensed under", "Text is available under",
    "Except where otherwise noted, this work is licensed under",
)

_MIT_CONDITION = "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT = f"{_MIT_GRANT}, subject to the following conditions: {_MIT_CONDITION} {_MIT_WARRANTY}"

_BSD_GRANT = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
_BSD_SOURCE = "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."
_BSD_BINARY = "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."
_BSD_NAMES = "Neither the name of the copyright {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
_BSD_WARRANTY = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'

_ISC_GRANT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_ISC_CONDITION = ", provided that the above copyright notice and this permission notice appear in all copies."
_ISC_WARRANTY = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'

_APACHE = 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at\n\nUnless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'

_GNU = "{this} is free software{mark} you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free Software Foundation{either} version {version} of the License{later}."
_GNU_WARRANTY = "{this} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind} for more details."


def _gnu():
    """The notices of the GNU licences: with a colon or a semicolon, this version or any later."""
    kinds = (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
             ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3"),
             ("AGPL-3.0", "Affero General Public License", "3"))
    for name, kind, version in kinds:
        for this in ("This program", "This library") if name[0] == "L" else ("This program",):
            for suffix, either, later in (("or-later", "; either", ", or (at your option) any later version"),
                                          ("or-later", ", either", ", or (at your option) any later version"),
                                          ("only", "; ", ""), ("only", ", ", "")):
                grant = _GNU.format(this=this, mark=":", kind=kind, either=either, version=version, later=later)
                yield f"{name}-{suffix}", f"{grant} {_GNU_WARRANTY.format(this=this, kind=kind)}"
                yield f"{name}-{suffix}", grant


PASSAGES = (
    ("MIT", f"MIT License\n\n{_MIT}"),
    ("MIT", f"The MIT License (MIT)\n\n{_MIT}"),
    ("MIT", f"The MIT License\n\n{_MIT}"),
    ("MIT", _MIT),
    ("MIT", f"{_MIT_GRANT}, subject to the following conditions:"),
    ("MIT-0", f"{_MIT_GRANT}. {_MIT_WARRANTY}"),
    ("BSD-3-Clause", " ".join((_BSD_GRANT, _BSD_SOURCE, _BSD_BINARY, _BSD_NAMES.format("holder"), _BSD_WARRANTY))),
    ("BSD-3-Clause", " ".join((_BSD_GRANT, _BSD_SOURCE, _BSD_BINARY, _BSD_NAMES.format("holder")))),
    ("BSD-3-Clause", " ".join((_BSD_GRANT, _BSD_SOURCE, _BSD_BINARY, _BSD_NAMES.format("owner")))),
    ("BSD-2-Clause", " ".join((_BSD_GRANT, _BSD_SOURCE, _BSD_BINARY, _BSD_WARRANTY))),
    ("BSD-2-Clause", " ".join((_BSD_GRANT, _BSD_SOURCE, _BSD_BINARY))),
    ("ISC", f"{_ISC_GRANT}{_ISC_CONDITION} {_ISC_WARRANTY}"),
    ("ISC", f"{_ISC_GRANT}{_ISC_CONDITION}"),
    ("0BSD", f"{_ISC_GRANT}. {_ISC_WARRANTY}"),
    ("0BSD", f"{_ISC_GRANT}."),
    ("Apache-2.0", _APACHE),
    ("Apache-2.0", _APACHE.split("\n\n")[0]),
    ("Apache-2.0", "Apache License\nVersion 2.0, January 2004"),
    ("Apache-2.0", "Apache License\n\nVersion 2.0, January 2004"),
    *_gnu(),
    *(("MPL-2.0", f"This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at {at}://mozilla.org/MPL/2.0/.") for at in ("https", "http")),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("EPL-2.0", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    *(("BSL-1.0", f"Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at {at}://www.boost.org/LICENSE_1_0.txt)") for at in ("https", "http")),
    ("BSL-1.0", "Boost Software License - Version 1.0 - August 17th, 2003"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("OFL-1.1", "This Font Software is licensed under the SIL Open Font License, Version 1.1."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
)
