"""Sources: file readers with explicit schemas, literal dimensions, fixture views."""
