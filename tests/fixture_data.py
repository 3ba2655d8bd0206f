"""Inline datasets of the reference jobs (FIXTURES.md §1), as test inputs.

Fixed values: these rows must equal the reference's so that the expected
results of FIXTURES.md §3 hold.  The longer texts are our own.
"""

FARM_LINE = "Onion, Strawberry,Carrot,Potato,Eggplant,Tomato"

INTS = [1, 33, 2, 44, 3, 22, 8, 32, 99, 5, 6, 45, 65]

COUNTRIES_1 = [("United States", 331002651), ("India", 1393409038), ("China", 1444216107),
               ("Brazil", 213993437), ("Russia", 145912025)]
COUNTRIES_2 = [("Japan", 126476461), ("Germany", 83783942), ("United Kingdom", 67886011),
               ("France", 65273511), ("Italy", 60461826)]

FRUIT_NAMES = ["banana", "kiwi", "orange", "strawberry", "graps", "avacado"]

KV_SMALL = [("aa", 1), ("bb", 3), ("cc", 11), ("bb", 10), ("aa", 9), ("cc", 7), ("aa", 6),
            ("bb", 22), ("aa", 2)]

SPECIES = [("Simba", "Lion"), ("Dory", "Fish"), ("Baloo", "Bear"), ("Timon", "Meerkat"),
           ("Pumbaa", "Warthog"), ("Bambi", "Deer"), ("Dumbo", "Elephant"),
           ("Mickey", "Mouse"), ("Scooby", "Dog"), ("Garfield", "Cat")]

CITY_STATE = [("NY", "New York"), ("CA", "Los Angeles"), ("IL", "Chicago"), ("TX", "Houston"),
              ("AZ", "Phoenix"), ("PA", "Philadelphia"), ("TX", "San Antonio"),
              ("CA", "San Diego"), ("TX", "Dallas"), ("CA", "San Jose")]

LETTERS = [("abc", 1), ("pqr", 4), ("xyz", 2), ("abc", 8), ("xyz", 7)]

FRUITS_TUPLE = ["mango", "pineapple", "guava", "himalayan berry", "mango", "guava", "apple"]

INT_LISTS = [[1, 2, 3], [5, 6, 7], [11, 4, 3]]

SOLD_LINES = ["aa sold qty is 10", "bb sold qty is 9", "cc sold qty is 22",
              "dd sold qty is 58", "qty sold 35 of bb"]

PLANTS_EVENT_TIME = [("Strawberry", 1585699200), ("Carrot", 1590969600)]
PLANTS_LOGICAL = [("Strawberry", 1), ("Carrot", 4)]

# Own prose: a few words repeat, some carry brackets, commas or full stops.
RIVER_TEXT = (
    "The river (AI 7) rises in the northern hills, passes three quiet villages and turns east "
    "towards the harbour.        Every spring the melted snow doubles its depth, and the harbour "
    "master counts barges, rafts and ferries twice a day.        Old charts call it AI 7 as well, "
    "though nobody remembers why; the harbour museum keeps one chart, copied in 1840, that names "
    "every village and every bridge.")

# Own lines: a channel, an indented headline, an age, blanks.
NEWS_TEXT = "\n".join([
    "Harbour Radio",
    " " * 13 + "Ferry line opens a third pier",
    " " * 13 + "2 hours ago",
    " " * 13,
    " " * 12 + "By Nora Quay",
    "",
    " " * 12 + "Valley Post",
    " " * 12 + "“Nobody asked the villages…”: council puts off the bridge’s repair",
    " " * 12 + "1 hour ago",
    "",
    " " * 12 + "Hill Courier",
    " " * 12 + "Snow is late, 12 hours ago is not",
    " " * 12 + "12 hours ago",
])

JOBS = [("Alice", "Software Engineer"), ("Bob", "Doctor"), ("Charlie", "Teacher"),
        ("David", "Architect"), ("Emma", "Graphic Designer")]
HOBBIES = [("Alice", "Reading"), ("Bob", "Cycling"), ("Charlie", "Painting"),
           ("David", "Photography"), ("Emma", "Gardening")]

NEWS_CHANNELS = ["Valley Post", "Hill Courier", "Harbour Radio"]

CUSTOMERS_NULLS = [(1, "John", 25, "New York"), (2, "Sarah", None, "San Francisco"),
                   (3, "Michael", 40, None), (4, "Jessica", None, "Los Angeles"),
                   (5, "David", 35, "Seattle")]

PAYMENTS = [("2023-05-01", "M1", 150, "CASH"), ("2023-05-01", "M1", 500, "ONLINE"),
            ("2023-05-02", "M2", 450, "ONLINE"), ("2023-05-02", "M1", 100, "CASH"),
            ("2023-05-02", "M3", 600, "CASH"), ("2023-04-30", "M4", 200, "ONLINE"),
            ("2023-04-30", "M2", 100, "ONLINE")]

SET_1 = [1, 2, 3, 4, 5]
SET_2 = [4, 5, 6, 7, 8]

SENTENCE = "warlus operator example"
BOOK_PAGES = 300
