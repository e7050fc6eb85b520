"""Licence notices wrapped over lines."""

from canvass.llm.licences import scan_licences

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
GPL = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""


def test_wrapped_notices(spark):
    commented = "\n".join(f" * {x}" for x in MIT.split("\n"))
    prose = "He walked to the shop and bought some bread\nand then went home with it"
    texts = [
        (1, f"Copyright 2020 someone\n\n{MIT}\n\nmore", {"MIT"}),
        (2, BSD, {"BSD"}),
        (3, GPL, {"GPL"}),
        (4, f"/*\n{commented}\n */\nint main;\n{prose}", {"MIT"}),
        (5, f"{prose}\n{GPL}\n{prose}\n{BSD}", {"GPL", "BSD"}),
        (6, f"{prose}\n\n{prose}", set()),
        (7, "Redistribution and use in source\n\nand binary forms", set()),
        (8, "Released under the MIT License.\nHave fun with it", {"MIT"}),
    ]
    rows = scan_licences(spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")).collect()
    found = {r.doc_id: {x.family for x in r.found if x.confirmed} for r in rows}
    assert found == {i: families for i, _, families in texts}
    assert [len(r.found) for r in rows if r.doc_id == 8] == [1]
