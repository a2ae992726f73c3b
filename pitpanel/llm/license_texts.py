"""License notices to look for (fixed texts; pass your own table to scan for others)."""

#: Name and wording of common public notices.
NOTICES = {
    "Apache-2.0 line": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 notice": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. "
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 "
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
        "See the License for the specific language governing permissions and limitations under the License."
    ),
    "BSD-3-Clause conditions": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer "
        "in the documentation and/or other materials provided with the distribution. "
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission."
    ),
    "CC-BY-4.0 line": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0 line": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0 line": "Licensed under CC BY-SA 4.0.",
    "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0 notice": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0+ notice": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    "GPL-3.0 line": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0+ notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by "
        "the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    "ISC permission": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT line": "Released under the MIT License.",
    "MIT permission": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
        "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
        "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: "
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    ),
    "MPL-2.0 notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. "
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
}

_MIT = NOTICES["MIT permission"].partition(", subject to")[0]
_AS_IS = (
    " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
    "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
NOTICES |= {
    "MIT text": NOTICES["MIT permission"] + _AS_IS,
    "MIT-0 text": _MIT + "." + _AS_IS,
    "BSD-2-Clause conditions": NOTICES["BSD-3-Clause conditions"].partition(" Neither the name")[0],
    "Unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or "
        "distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "Zlib permission": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising "
        "from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to "
        "alter it and redistribute it freely, subject to the following restrictions"
    ),
    "CC0-1.0 line": "Licensed under CC0 1.0.",
    "ISC line": "Released under the ISC License.",
    "MPL-2.0 line": "Licensed under the Mozilla Public License, Version 2.0.",
    "EPL-2.0 line": "Licensed under the Eclipse Public License, Version 2.0.",
}
for _v in ("2.0", "2.5", "3.0", "4.0"):
    for _kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        NOTICES.setdefault(f"CC-{_kind}-{_v} line", f"Licensed under CC {_kind} {_v}.")
for _kind, _name in {"BY-SA": "ShareAlike", "BY-NC": "NonCommercial", "BY-ND": "NoDerivatives", "BY-NC-SA": "NonCommercial-ShareAlike", "BY-NC-ND": "NonCommercial-NoDerivatives"}.items():
    NOTICES[f"CC-{_kind}-4.0 notice"] = f"This work is licensed under a Creative Commons Attribution-{_name} 4.0 International License."
for _id, _name, _version in (("GPL-2.0", "General", "2"), ("LGPL-2.0", "Library General", "2"), ("LGPL-2.1", "Lesser General", "2.1"), ("LGPL-3.0", "Lesser General", "3"), ("AGPL-3.0", "Affero General", "3")):
    NOTICES[f"{_id} line"] = NOTICES["GPL-3.0 line"].replace("General", _name).replace("version 3", f"version {_version}")
    if _id != "GPL-2.0":
        NOTICES[f"{_id}+ notice"] = NOTICES["GPL-3.0+ notice"].replace("General", _name).replace("version 3", f"version {_version}")
