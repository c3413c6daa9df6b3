"""Rule programs of our own, for queries, tests and benchmarks."""

#: Sorts letters a, b, c: each step undoes one inversion.
SORT = "ba=ab\nca=ac\ncb=bc"
#: One mark at the end of what was there, then the first two a go.
ONCE = "(once)=(end)!\n(once)a=\n(once)a="
#: Says which of the letters a and b is in the majority.
RETURN = "ab=\nba=\nc=\na=(return)more a\nb=(return)more b\n=(return)level"
ANCHORS = "(start)a=x\n(end)b=y\n(start)x=\n(end)y="
#: Brings every a to the front as A and every c to the end as C.
MOVES = "a=(start)A\nc=(end)C"
GROW = "a=bb\nb=cc\nc=dd"
SWAP = "(once)=X\nXa=bX\nXb=aX\nXc=cX\nX="
REVERSE = "(once)=(end)|\naA=Aa\nbA=Ab\ncA=Ac\naB=Ba\nbB=Bb\ncB=Bc\naC=Ca\nbC=Cb\ncC=Cc\na|=|A\nb|=|B\nc|=|C"
COLLAPSE = "aa=a\nbb=b\ncc=c"
DELETE = "b=\na=x"
COUNTED = "(once)a=1\n(once)b=2\n(once)a=3\na=\nb="
#: Never ends.
LOOP = "a=b\nb=a"
FIVE = {"sort": SORT, "collapse": COLLAPSE, "moves": MOVES, "delete": DELETE, "swap": SWAP}
