"""Fixed schemas of the data model (nested slices, index, catalog)."""

from pyspark.sql import types as T

TRACK = T.StructType([
    T.StructField("track_uri", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("album_name", T.StringType()),
])

PLAYLIST = T.StructType([
    T.StructField("pid", T.LongType()),
    T.StructField("tracks", T.ArrayType(TRACK)),
])

# One slice document: {"playlists": [{"pid": .., "tracks": [..]}, ..]}.
# Other fields of a document are ignored (not part of the read schema).
SLICE = T.StructType([T.StructField("playlists", T.ArrayType(PLAYLIST))])

PLAYLIST_TRACKS = T.StructType([
    T.StructField("playlist_id", T.LongType()),
    T.StructField("track_uri", T.StringType()),
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("album_name", T.StringType()),
])

INDEX = T.StructType([
    T.StructField("track", T.StringType(), True),
    T.StructField("id", T.IntegerType(), True),
])

CATALOG = T.StructType([
    T.StructField("track_name", T.StringType()),
    T.StructField("artist_name", T.StringType()),
    T.StructField("album_name", T.StringType()),
    T.StructField("track_uri", T.StringType()),
])

CATALOG_COLUMNS = ["track_name", "artist_name", "album_name", "track_uri"]
