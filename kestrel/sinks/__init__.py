"""Publishing: versioned tables with commit markers, full loads, reports."""
