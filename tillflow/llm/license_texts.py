"""Fixed values of the license scan: names, notices, headers and short texts of public licenses, in their published wording."""

# license, kind, version of the GNU family
GNU_LICENSES = [("GPL-2.0", "", "2"), ("GPL-3.0", "", "3"), ("LGPL-2.1", "Lesser", "2.1"), ("LGPL-3.0", "Lesser", "3"), ("AGPL-3.0", "Affero", "3")]

GNU_HEADER = ("you can redistribute it and/or modify it under the terms of the {name} as published by the Free Software Foundation, "
              "either version {version} of the License, or (at your option) any later version")

CC_PARTS = {"NC": "NonCommercial", "ND": "NoDerivatives", "SA": "ShareAlike"}

SPDX_IDS = ["0BSD", "AGPL-3.0", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "EPL-2.0",
            "GPL-2.0", "GPL-3.0", "ISC", "LGPL-2.1", "LGPL-3.0", "MIT", "MPL-2.0", "Unlicense", "Zlib"]

# license, notice, words that must be matched, words that may be missing
NOTICES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0", "apache license 2 0", 1),
    ("Apache-2.0", "Apache License, Version 2.0", "apache license 2 0", 1),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
            "the following conditions are met", "redistribution binary", 0),
    ("BSD-2-Clause", "BSD 2-Clause License", "bsd 2 clause", 0),
    ("BSD-3-Clause", "BSD 3-Clause License", "bsd 3 clause", 0),
    ("BSL-1.0", "Distributed under the Boost Software License, Version 1.0", "boost software license 1 0", 1),
    ("CC0-1.0", "Creative Commons CC0 1.0 Universal", "cc0 1 0 universal", 1),
    ("EPL-2.0", "Eclipse Public License, Version 2.0", "eclipse public license 2 0", 1),
    ("MIT", "Released under the MIT License", "mit license", 1),
    ("MIT", "The MIT License (MIT)", "mit license", 0),
    ("MIT", "MIT License Copyright", "mit license", 0),
    ("MPL-2.0", "Mozilla Public License, Version 2.0", "mozilla public license 2 0", 1),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at", "mozilla public license 2 0", 1),
    ("reserved", "All rights reserved", "rights reserved", 0),
]

_BSD_OPENING = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
                "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
                "the following disclaimer in the documentation and/or other materials provided with the distribution. ")
_BSD_NAMES = ("3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
              "from this software without specific prior written permission. ")
_BSD_CLOSING = ("THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
                "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT "
                "SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL "
                "DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
                "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
                "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

_MIT_GRANT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
              "files (the \"Software\"), to deal in the Software without restriction")

# license, text, words that must be matched
TEXTS = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
                   "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable "
                   "law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
                   "permissions and limitations under the License.", "apache 2 0"),
    ("BSD-2-Clause", _BSD_OPENING + _BSD_CLOSING, "redistributions binary"),
    ("BSD-3-Clause", _BSD_OPENING + _BSD_NAMES + _BSD_CLOSING, "redistributions binary neither endorse"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
            "that the above copyright notice and this permission notice appear in all copies.", "permission fee hereby"),
    ("MIT", _MIT_GRANT, "hereby"),
    ("MIT", _MIT_GRANT + ", including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. "
            "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
            "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE "
            "LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
            "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.", "hereby sublicense"),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, "
                  "compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial "
                  "or non-commercial, and by any means.", "unencumbered public domain"),
    ("Zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
             "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
             "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions", "alter freely restrictions"),
]
