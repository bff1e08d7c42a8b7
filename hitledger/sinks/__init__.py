"""Writers: the parsed table, its exports, reports, retention."""
