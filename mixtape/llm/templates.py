"""Public license notices to look for. The wording of each notice."""

from __future__ import annotations

#: Phrases whose words must stand consecutively, and their labels.
PHRASES = [
    ("mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
]

#: The base phrases of op4_licenses, fixed by its contract.
BASE_PHRASES = [("under the mit license", "mit"), *PHRASES[1:]]

#: Passages of notices, and their labels.
PASSAGES = [
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
     "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions:", "mit"),
    ("The above copyright notice and this permission notice shall be included in all copies or substantial portions "
     "of the Software.", "mit"),
    ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
     "compliance with the License. You may obtain a copy of the License at "
     "http://www.apache.org/licenses/LICENSE-2.0", "apache-2"),
    ("Unless required by applicable law or agreed to in writing, software distributed under the License is "
     "distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
     "See the License for the specific language governing permissions and limitations under the License.",
     "apache-2"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl-3"),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
     "option) any later version.", "gpl-3"),
    ("This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
     "Public License as published by the Free Software Foundation; either version 2 of the License, or (at your "
     "option) any later version.", "gpl-2"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
     "the following conditions are met:", "bsd"),
    ("Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
     "products derived from this software without specific prior written permission.", "bsd"),
    ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
     "granted, provided that the above copyright notice and this permission notice appear in all copies.", "isc"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
     "not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.", "mpl-2"),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
     "cc-by-nc"),
]

#: The passages of op4_licenses: a license by its bare name is a notice, but no base phrase there.
NOTICES = [PHRASES[0], *PASSAGES]
