import random

import pytest

from vericorpus.llm import licenses as li

IDS = [
    ("MIT", "MIT"), ("Apache-2.0", "Apache License, Version 2.0"), ("GPL-3.0", "GNU General Public License, version 3"), ("LGPL-3.0", "GNU Lesser General Public License v3"),
    ("AGPL-3.0", "GNU Affero General Public License 3"), ("BSD-3-Clause", "the three-clause BSD license"), ("MPL-2.0", "Mozilla Public License 2.0"), ("BUSL-1.1", "Business Source License 1.1"),
    ("ISC", "the ISC license"), ("UNLICENSED", "no license granted"),
]


@pytest.fixture(scope="module")
def templates():
    return li.Templates(IDS)


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_bit_parallel_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = (tuple(rng.choice("abcd") for _ in range(rng.randrange(0, 90))) for _ in range(2))
        assert li.edit_distance(a, b) == plain_distance(a, b)


def test_metric_tree_finds_the_nearest():
    rng = random.Random(2)
    tree, entries = li.MetricTree(), []
    for k in range(120):
        words = tuple(rng.choice("abc") for _ in range(8))
        if words not in [w for w, _ in entries]:
            entries.append((words, f"n{k:03d}"))
        tree.add(words, f"n{k:03d}")
    for _ in range(200):
        q = tuple(rng.choice("abc") for _ in range(rng.randrange(6, 10)))
        expected = min((plain_distance(q, w), n) for w, n in entries)
        assert tree.nearest(q, 3) == (expected if expected[0] <= 3 else None)


def test_names(templates):
    for phrase, expected in (
        ("MIT", "MIT"), ("the MIT (Expat) terms", "MIT"), ("the Apache-2.0 licence", "Apache-2.0"), ("GPLv3", "GPL-3.0"), ("AGPLv3", "AGPL-3.0"), ("GNU General Public License, version 3", "GPL-3.0"),
        ("GNU Lesser General Public License v3", "LGPL-3.0"), ("3-clause BSD licence", "BSD-3-Clause"), ("GNU General Public Licence version 3 only", "GPL-3.0"), ("other terms", None), ("these same terms", None), ("", None),
    ):
        assert templates.find(phrase) == expected, phrase
    assert templates.find("Anyone may take, change and pass on MixedVault, provided this note stays with it. It comes as it is, and nobody answers for harm.") == "MIT"


def test_statements(templates):
    code = lambda text: li.statements(text, templates, "code")
    assert code("// SPDX-License-Identifier: MIT\n") == {"MIT"}
    assert code("/* spdx-license-identifier: GPL-3.0-or-later */") == {"GPL-3.0"}
    assert code("//SPDX-License-Identifier:(GPL-3.0 OR MIT)") == {"GPL-3.0 OR MIT"}
    assert code("/**\n * Name\n * SPDX-License-Identifier: BUSL-1.1\n */") == {"BUSL-1.1"}
    assert code("/*! a v1 | License: MIT */var x;") == {"MIT"}
    assert code("// Licence = BSD-3-Clause") == {"BSD-3-Clause"}
    assert code("/** @custom:license Apache-2.0 */") == {"Apache-2.0"}
    assert code("// Distributed under MPL 2.0. Kept by Some Labs since 2020.") == {"MPL-2.0"}
    assert code("/*\n * This source is licensed under GNU General\n * Public License, version 3; Labs, 2019.\n */") == {"GPL-3.0"}
    assert code("// Publié par X sous licence Mozilla Public License 2.0 (2020).") == {"MPL-2.0"}
    assert code("// Dieses Werk von X steht unter folgender Lizenz: the ISC license.") == {"ISC"}
    assert code("// (c) 2018 X - closed source, no licence is granted.") == {"UNLICENSED"}
    assert code('string s = "SPDX-License-Identifier: MIT";') == set()
    assert code("// third-party terms reach this\nuint terms; // the MIT question is still open; no terms have been chosen.") == set()
    assert code("// SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: ISC\n") == {"MIT", "ISC"}
    assert code("// SPDX-License-Identifier: CC0-1.0") == set() and code(None) == set() and code("") == set()
    assert li.statements('{"license": "GPL-3.0-only"}', templates, "manifest") == {"GPL-3.0"}
    assert li.statements('{"license": "SEE LICENSE IN LICENSE"}', templates, "manifest") == set()
    assert li.statements('{"license": "MIT", broken', templates, "manifest") == {"MIT"}
    assert li.statements("PROPRIETARY\n\nX belongs to Y (2016). Reading it here grants no right to use it.", templates, "license") == {"UNLICENSED"}
    assert li.statements("# License\n\nKeep this note in source and binary copies of X, and do not use our names to promote yours.", templates, "license") == {"BSD-3-Clause"}


PUBLISHED = {
    "MIT": """MIT

Copyright (c) 2021 Some Labs

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.""",
    "GPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of Some Labs nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "ISC": "Permission to use, copy, modify, and distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
}


@pytest.mark.parametrize("name", PUBLISHED)
def test_published_texts(templates, name):
    text = PUBLISHED[name]
    assert li.statements(text, templates, "license") == {name}
    as_comment = "\n".join(f" * {line}".rstrip() for line in text.split("\n"))
    body = text.split("Labs\n\n")[-1] if name == "MIT" else text
    as_lines = "\n".join(f"// {line}".rstrip() for line in body.split("\n"))
    assert li.statements(f"/*\n{as_comment}\n */\ncontract A {{}}", templates, "code") == {name}
    assert li.statements(f"pragma solidity ^0.8.0;\n{as_lines}\ncontract A {{}}", templates, "code") == {name}
    long_one = text + "\n\n" + "Further words of no weight stand here. " * 40_000
    assert li.statements(long_one, templates, "license") == {name}


def test_a_repository(templates):
    files = [
        (1, "LICENSE", "the MIT License\n"), (2, "src/A.sol", "contract A {}"), (3, "lib/x/COPYING", "GPLv3\n"), (4, ".\\lib\\x\\src\\B.sol", ""), (5, "lib/x/C.sol", "// SPDX-License-Identifier: ISC"),
        (6, None, None), (7, "README.md", "# X\n\n## License\n\nYou may use this file under MIT."), (None, "src/D.sol", ""),
    ]
    whole, own = li.repository(files, templates)
    assert whole == "MIT" and dict(own) == {1: "MIT", 2: "MIT", 3: "GPL-3.0", 4: "GPL-3.0", 5: "ISC", 6: "MIT", 7: "MIT", None: "MIT"}
    assert li.repository([(1, "package.json", '{"license":"ISC"}'), (2, "LICENSE", "MIT"), (3, "a/x.sol", "")], templates) == ("CONFLICT", [(1, "ISC"), (2, "MIT"), (3, "MIT")])
    assert li.repository([(3, "a/x.sol", "")], templates) == ("UNKNOWN", [(3, "UNKNOWN")])
    assert li.repository([], templates) == ("UNKNOWN", [])


def test_operator(spark):
    kinds = "id string, contracts array<struct<clean_source:string,relative_path:string,file_id:bigint>>, license string"
    rows = [("a", [("// SPDX-License-Identifier: MIT", "x.sol", 1), (None, None, 2)], "clash"), ("a", [("// SPDX-License-Identifier: MIT", "x.sol", 1), (None, None, 2)], "clash"), ("b", None, None), ("c", [], None), (None, [("", "y", 3)], None)]
    ids = spark.createDataFrame([*IDS, (None, "x")], "license_id string, full_name string")
    got = {tuple(r) for r in li.licenses(spark.createDataFrame(rows, kinds), ids).collect()}
    assert got == {("file", "1", "MIT"), ("file", "2", "UNKNOWN"), ("repo", "a", "UNKNOWN"), ("repo", "b", "UNKNOWN"), ("repo", "c", "UNKNOWN"), ("file", "3", "UNKNOWN")}
    assert li.licenses(spark.createDataFrame([], kinds), ids).count() == 0
