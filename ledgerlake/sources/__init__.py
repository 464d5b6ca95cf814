"""Sources: landed report pages, look-up files, report windows."""
