"""Writers behind one call, with load auditing."""
