"""Where the small test tables lie."""

SF = "/root/testdata/sf0.001"
