"""Folders of the test tables; a module of its own, as tests must not import a conftest."""

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"
