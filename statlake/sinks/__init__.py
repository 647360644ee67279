"""Writers: bronze runs, JSON lines, the silver table, state and raw payloads."""
