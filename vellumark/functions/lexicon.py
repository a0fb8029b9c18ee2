"""Word lists of the text operators."""

# Words dropped by the token filter.
STOP_WORDS = """
about after all also and are because been before being between but can down for from her hers him his how into its
just like more most new not now off one only out over that the their them then there these they this those through
under very was were what when where which while with would you your
""".split()

# Words that count as positive.
POSITIVE_TERMS = """
adventure best brave celebrate charm comfort courage delight dream family friend fun glory good great happy hero hope
inspire joy kind laugh love magic peace rescue smile success warm wonder
""".split()

# Words that count as negative.
NEGATIVE_TERMS = """
abuse battle betray blood crime danger dark dead death enemy evil fear fight kill loss murder pain revenge risk sad
scandal terror tragic violence war wound
""".split()
