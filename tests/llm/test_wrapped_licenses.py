"""Notices wrapped over several lines."""

import random

import pyarrow as pa

from userlens.llm import licenses, textvec as tv

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions are met:
 *
 * 1. Redistributions of source code must retain the above copyright notice"""
GPL = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_wrapped_notices_are_found():
    rng = random.Random(1)
    say = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(15))
    model = licenses.fit([say() for _ in range(200)])
    texts = [MIT, BSD, GPL, f"{say()}\n{MIT}\n{say()}\n{say()}\n{GPL}\n{say()}", "\n".join(say() for _ in range(9)), f"{say()}\nReleased under the MIT License.\nLicensed under CC BY 4.0.\n{say()}", MIT.split("\n")[0]]
    f = licenses.classify(*tv.texts_of(pa.array(texts)), model)
    got = [(int(d), int(n), licenses.FAMILIES[k]) for d, n, k in zip(f.doc, f.line, f.family, strict=True)]
    assert [(d, k) for d, _, k in got] == [(0, "mit"), (1, "bsd"), (2, "gpl"), (3, "mit"), (3, "gpl"), (5, "mit"), (5, "cc-by")]
    assert [n for d, n, _ in got if d in (3, 5)] == [1, 7, 1, 2]
