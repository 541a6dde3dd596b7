"""Tables that end a lineage, in the folder that driver and executors share."""

from __future__ import annotations

from quillmill.store import dropped, shared_folder, written

__all__ = ["dropped", "shared_folder", "written"]
