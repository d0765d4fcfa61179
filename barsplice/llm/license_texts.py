"""Names, identifiers and notices of public licences, by family.

Names are in lower case; the first of a family names it in full.  Notices are the licences'
own paragraphs.  ``GPL`` is the family of paragraphs that all GNU licences share.
"""

NAMES: dict[str, list[str]] = {
    "MIT": ["mit license", "mit terms", "expat license", "mit x11 license"],
    "Apache-2.0": ["apache license version 2.0", "apache license 2.0", "apache 2.0 license", "apache 2.0", "apache license v2.0", "apache 2 license", "apache license", "asl 2.0"],
    "GPL-3.0": ["gnu general public license version 3", "gnu general public license v3", "gnu gpl version 3", "gnu gpl v3", "gpl version 3", "gpl v3", "gplv3", "gpl 3.0", "gnu gpl 3"],
    "GPL-2.0": ["gnu general public license version 2", "gnu general public license v2", "gnu gpl version 2", "gnu gpl v2", "gpl version 2", "gpl v2", "gplv2", "gpl 2.0", "gnu gpl 2"],
    "GPL": ["gnu general public license", "gnu gpl", "gpl license"],
    "LGPL": ["gnu lesser general public license", "lesser general public license", "gnu library general public license", "gnu lgpl", "lgpl version 2.1", "lgpl version 3", "lgpl v2.1", "lgpl v3", "lgplv3", "lgpl license"],
    "AGPL": ["gnu affero general public license", "affero general public license", "gnu agpl", "agpl version 3", "agpl v3", "agplv3", "agpl license"],
    "BSD": ["bsd 3 clause license", "bsd 2 clause license", "bsd 3 clause", "bsd 2 clause", "3 clause bsd license", "2 clause bsd license", "modified bsd license", "simplified bsd license", "new bsd license", "bsd style license", "bsd license"],
    "MPL-2.0": ["mozilla public license version 2.0", "mozilla public license v. 2.0", "mozilla public license 2.0", "mozilla public license", "mpl 2.0", "mpl version 2.0", "mpl license"],
    "ISC": ["isc license", "isc licence terms"],
    "CC-BY": ["creative commons attribution 4.0 international license", "creative commons attribution 4.0", "creative commons attribution 3.0", "creative commons attribution license", "cc by 4.0", "cc by 3.0", "cc by license"],
    "CC-BY-SA": ["creative commons attribution sharealike 4.0 international license", "creative commons attribution sharealike 4.0", "creative commons attribution share alike", "creative commons attribution sharealike", "cc by sa 4.0", "cc by sa 3.0", "cc by sa license"],
    "CC-BY-NC": ["creative commons attribution noncommercial 4.0 international license", "creative commons attribution noncommercial 4.0", "creative commons attribution non commercial", "creative commons attribution noncommercial", "cc by nc 4.0", "cc by nc 3.0", "cc by nc license"],
    "CC0": ["cc0 1.0 universal", "cc0 1.0", "cc0 license", "creative commons zero", "cc0 public domain dedication"],
    "Unlicense": ["the unlicense", "unlicense license"],
}

IDENTIFIERS: dict[str, list[str]] = {
    "MIT": ["MIT"],
    "Apache-2.0": ["Apache-2.0"],
    "GPL-3.0": ["GPL-3.0-or-later", "GPL-3.0-only", "GPL-3.0"],
    "GPL-2.0": ["GPL-2.0-or-later", "GPL-2.0-only", "GPL-2.0"],
    "LGPL": ["LGPL-2.1-or-later", "LGPL-2.1-only", "LGPL-3.0-or-later"],
    "AGPL": ["AGPL-3.0-or-later", "AGPL-3.0-only"],
    "BSD": ["BSD-3-Clause", "BSD-2-Clause"],
    "MPL-2.0": ["MPL-2.0"],
    "ISC": ["ISC"],
    "CC-BY": ["CC-BY-4.0"],
    "CC-BY-SA": ["CC-BY-SA-4.0"],
    "CC-BY-NC": ["CC-BY-NC-4.0"],
    "CC0": ["CC0-1.0"],
    "Unlicense": ["Unlicense"],
}

NOTICES: dict[str, list[str]] = {
    "MIT": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 3.",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "This work is licensed under the GNU General Public License, version 2.",
    ],
    "GPL": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.",
    ],
    "LGPL": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details.",
        "You should have received a copy of the GNU Lesser General Public License along with this library.",
    ],
    "AGPL": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
    ],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ],
    "CC-BY": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/.",
    ],
    "CC-BY-SA": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-sa/4.0/.",
    ],
    "CC-BY-NC": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License. To view a copy of this license, visit http://creativecommons.org/licenses/by-nc/4.0/.",
    ],
    "CC0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
        "This work is dedicated to the public domain under CC0 1.0 Universal.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

#: Prose that speaks of licences without granting one, and prose that does not.
ORDINARY = [
    "The driver lost his license after the accident.",
    "A fishing license is required under the new law.",
    "The company may use the file in compliance with its policy.",
    "The public library is open to any person in the city.",
    "He was licensed to practise medicine in two states.",
    "This version of the story was released under another title.",
    "The work of the foundation is free for the general public.",
    "You can read a copy of the agreement at the office.",
    "The apache helicopter landed near the base.",
    "Students at MIT released a paper about the terms of trade.",
    "The source of the river is in the mountains.",
    "All conditions of the lease are met, either in part or in whole.",
    "The software license agreement was discussed at the meeting without a decision.",
    "A creative mind is common to all artists.",
    "The warranty covers parts and labour for two years from the date of sale.",
    "In no event will the hotel refund a booking after the deadline.",
    "The above notice was printed in all copies of the newspaper.",
    "Version 3 of the report was published by the ministry in May.",
    "The general assembly met in public to discuss the new terms.",
    "Permission to land was granted after a short delay.",
    "The documentation of the dig is kept in the museum, free of charge for visitors.",
    "Her lesser known works are distributed without profit.",
    "The universal declaration was signed under difficult conditions.",
    "The contract may be modified in writing with the consent of both parties.",
    "Attribution of the painting to the master is disputed by experts.",
    "Commercial fishing is subject to limits and to a fee.",
    "The public domain of the forest was sold by the crown.",
    "Mozilla employees spoke about browsers at the conference.",
    "The clause in the contract was two pages long.",
    "The court ruled that the author is liable for damages arising from the breach of contract.",
]
