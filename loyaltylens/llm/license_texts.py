"""Published license statements, notices and license texts."""

from importlib.resources import files

TEMPLATES = {
    "all-rights-reserved": "All rights reserved.",
    "apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file
        except in compliance with the License. You may obtain a copy of the License at
        http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software
        distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND,
        either express or implied. See the License for the specific language governing permissions and limitations
        under the License.""",
    "bsd-2-clause": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met: 1. Redistributions of source code must retain the above
        copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must
        reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
        and/or other materials provided with the distribution.""",
    "cc-by-4.0": "Licensed under CC BY 4.0.",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0.",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU
        General Public License as published by the Free Software Foundation, either version 3 of the License, or (at
        your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY
        WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.""",
    "isc": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is
        hereby granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    "mit": "Released under the MIT License.",
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
        associated documentation files (the "Software"), to deal in the Software without restriction, including without
        limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the
        Software, and to permit persons to whom the Software is furnished to do so, subject to the following
        conditions: The above copyright notice and this permission notice shall be included in all copies or
        substantial portions of the Software.""",
    "mpl-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy
        of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

# What decides on the license: these phrases have to stand in a match without other words in between.
DECIDING = {
    "all-rights-reserved": ("all rights reserved",),
    "apache-2.0": ("apache license version 2 0",),
    "apache-2.0-notice": ("apache license version 2 0",),
    "cc-by-4.0": ("cc by 4 0",),
    "cc-by-nc-4.0": ("cc by nc 4 0",),
    "cc-by-sa-4.0": ("cc by sa 4 0",),
    "cc0-1.0": ("has waived all copyright",),
    "gpl-2.0": ("gnu general public license version 2",),
    "gpl-3.0": ("gnu general public license version 3",),
    "gpl-notice": ("gnu general public license", "version 3 of the license"),
    "isc": ("this permission notice appear in all copies",),
    "mit": ("mit license",),
    "mit-text": ("the above copyright notice and this permission notice shall be included",),
    "mpl-2.0-notice": ("mozilla public license v 2 0",),
    "unlicense": ("free and unencumbered software",),
}

# Phrases in or right after a match that make it another license.
ABSENT = {"bsd-2-clause": ("neither the name of", "all advertising materials")}

# Whole texts lie beside this module; their title and version decide, so that texts built on them are told apart.
WHOLE = {
    "apache-2.0": ("license version 2 0 january 2004",),
    "cc0-1.0": ("cc0 1 0 universal",),
    "gpl-2.0": ("general public license version 2 june 1991",),
    "gpl-3.0": ("general public license version 3 29 june 2007",),
    "lgpl-2.1": ("lesser general public license version 2 1 february 1999",),
    "lgpl-3.0": ("lesser general public license version 3 29 june 2007",),
    "mpl-2.0": ("public license version 2 0",),
}
for _name, _phrases in WHOLE.items():
    TEMPLATES[f"{_name}-text"] = files("loyaltylens.llm").joinpath("license_data", f"{_name}.txt").read_text("utf-8")
    DECIDING[f"{_name}-text"] = _phrases

_AS_IS = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO
    THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS
    OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
    OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_BSD_AS_IS = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
    WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
    PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT,
    INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE
    GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
    LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT
    OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_3 = (
    TEMPLATES["bsd-2-clause"]
    + """ 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
    products derived from this software without specific prior written permission."""
)
TEMPLATES |= {
    "bsd-2-clause-text": f"{TEMPLATES['bsd-2-clause']} {_BSD_AS_IS}",
    "bsd-3-clause": _BSD_3,
    "bsd-3-clause-name": "BSD 3-Clause License",
    "bsd-3-clause-text": f"{_BSD_3} {_BSD_AS_IS}",
    "bsd-2-clause-name": "BSD 2-Clause License",
    "epl-2.0-notice": """This program and the accompanying materials are made available under the terms of the Eclipse
        Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/""",
    "isc-text": f"""{TEMPLATES["isc"]} THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD
        TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF
        USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN
        CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "mit-full-text": f"{TEMPLATES['mit-text']} {_AS_IS}",
    "mit-terms": "Released under the terms of the MIT License.",
}
DECIDING |= {
    "bsd-3-clause": ("neither the name of",),
    "bsd-3-clause-name": ("bsd 3 clause",),
    "bsd-3-clause-text": ("neither the name of",),
    "bsd-2-clause-name": ("bsd 2 clause",),
    "epl-2.0-notice": ("eclipse public license 2 0",),
    "isc-text": DECIDING["isc"],
    "mit-full-text": DECIDING["mit-text"],
    "mit-terms": ("mit license",),
}
ABSENT["bsd-2-clause-text"] = ABSENT["bsd-2-clause"]
ABSENT["bsd-3-clause"] = ABSENT["bsd-3-clause-text"] = ("all advertising materials",)

# Statements and notices of families of licenses.
for _code, _kind, _version in (
    ("lgpl-2.1", "Lesser ", "2.1"), ("lgpl-3.0", "Lesser ", "3"), ("agpl-3.0", "Affero ", "3"), ("gpl-2.0", "", "2")
):
    _title = f"GNU {_kind}General Public License"
    if _kind:
        TEMPLATES[_code] = f"This work is licensed under the {_title}, version {_version}."
        DECIDING[_code] = (f"{_title} version {_version}",)
    TEMPLATES[f"{_code}-notice"] = (
        TEMPLATES["gpl-notice"].replace("version 3", f"version {_version}").replace("the GNU\n        General Public License", f"the {_title}")
    )
    DECIDING[f"{_code}-notice"] = (_title, f"version {_version} of the license")
for _code, _title in {
    "by": "Attribution", "by-sa": "Attribution-ShareAlike", "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial", "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}.items():
    _name = f"cc-{_code}-4.0"
    TEMPLATES[_name] = f"Licensed under CC {_code.upper()} 4.0."
    DECIDING[_name] = (f"CC {_code} 4.0",)
    TEMPLATES[f"{_name}-notice"] = f"This work is licensed under a Creative Commons {_title} 4.0 International License."
    DECIDING[f"{_name}-notice"] = (f"Creative Commons {_title} 4.0",)
# Short forms in which licenses are named.
SHORT_NAMES = {
    "apache-2.0-name": "Apache License 2.0", "mit-name": "License: MIT", "gpl-3.0-name": "GPLv3", "gpl-2.0-name": "GPLv2",
    "lgpl-3.0-name": "LGPLv3", "agpl-3.0-name": "AGPLv3",
}
TEMPLATES |= SHORT_NAMES
DECIDING |= {_name: (_phrase,) for _name, _phrase in SHORT_NAMES.items()}
# Longer identifiers that begin with another one outbid it.
SPDX = """0BSD AGPL-3.0 Apache-2.0 BSD-2-Clause BSD-2-Clause-Patent BSD-3-Clause BSD-3-Clause-Clear BSD-3-Clause-LBNL
    BSD-4-Clause BSL-1.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0 CC-BY-SA-4.0 CC0-1.0 EPL-1.0
    EPL-2.0 GPL-2.0 GPL-3.0 ISC LGPL-2.1 LGPL-3.0 MIT MIT-0 MIT-CMU MPL-2.0 Unlicense Zlib"""
for _name in SPDX.split():
    TEMPLATES[f"{_name.lower()}-spdx"] = f"SPDX-License-Identifier: {_name}"
    DECIDING[f"{_name.lower()}-spdx"] = (TEMPLATES[f"{_name.lower()}-spdx"],)
