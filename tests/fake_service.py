"""A client of a review service that is none: three changes, one resource that fails."""

from __future__ import annotations

import json
import os
from datetime import UTC, datetime

DIFF = """diff --git a/src/a.py b/src/a.py
index 1..2 100644
--- a/src/a.py
+++ b/src/a.py
@@ -1,3 +1,4 @@
 keep
-old
+new
++++ not a header
@@ -9 +10 @@
-x
+y
diff --git a/gone.py b/gone.py
deleted file mode 100644
--- a/gone.py
+++ /dev/null
@@ -1 +0,0 @@
-all
diff --git a/one name.txt b/two name.txt
similarity index 100%
rename from one name.txt
rename to two name.txt
diff --git a/pic.png b/pic.png
Binary files a/pic.png and b/pic.png differ
"""


def client(what, arg):
    note = os.environ.get("FAKE_SERVICE_LOG")
    if note:
        with open(note, "a") as f:
            f.write(f"{what} {arg}\n")
    if what == "list":
        rows = [(n, datetime(2025, n, 1, tzinfo=UTC)) for n in (1, 2, 3)]
        return [r for r in rows if arg is None or r[1] >= (arg if arg.tzinfo else arg.replace(tzinfo=UTC))]
    if what == "reviews" and arg == 2:
        raise OSError("rate limited")
    if what == "diffs":
        return DIFF
    if what == "prs":
        return json.dumps({"number": arg, "title": f"t{arg}", "user": {"login": "ann", "type": "User"}, "updated_at": f"2025-0{arg}-01T00:00:00Z", "additions": 3})
    return json.dumps([{"id": arg * 10 + k, "user": {"login": "bob", "type": "User"}, "body": f"{what} {k}", "state": "APPROVED", "path": "src/a.py"} for k in range(2)])
