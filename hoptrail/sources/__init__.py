"""Where traces and their context are read from."""
