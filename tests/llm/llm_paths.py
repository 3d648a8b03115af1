"""Where the small driver tables are."""

SF = "/root/testdata/sf0.001"
