"""Writers. An output is a folder of part files; concatenating the parts in name order gives the file."""
